from collections import defaultdict

from lexloom.llm import suffixes
from tests.llm.cases import frame, prose, rows


def slow(texts, size=50):
    """Per row: which words lie in a run of ``size`` words that another row has."""
    owners, split = defaultdict(set), {i: (t or "").encode().split() for i, t in texts.items()}
    for i, w in split.items():
        for p in range(len(w) - size + 1):
            owners[tuple(w[p : p + size])].add(i)
    out = {}
    for i, w in split.items():
        out[i] = [False] * len(w)
        for p in range(len(w) - size + 1):
            if len(owners[tuple(w[p : p + size])]) > 1:
                out[i][p : p + size] = [True] * size
    return out


def covered(row):
    out = [False] * row.n_words
    for s in row.spans:
        out[s.start : s.end] = [True] * (s.end - s.start)
    return out


def test_spans_equal_brute_force(spark):
    some = list({r[0]: r for r in rows() if r[0] is not None}.values())
    got = {r.doc_id: covered(r) for r in suffixes.repeated_passages(frame(spark, some)).collect()}
    want = slow({r[0]: r[1] for r in some})
    assert {k for k in want if got[k] != want[k]} == set()


def test_a_passage_that_many_texts_share(spark):
    import random

    rng = random.Random(5)
    passage = prose(rng, 55)
    some = [(i, f"{prose(rng, 30)} {passage} {prose(rng, 30)}", *[None] * 8) for i in range(60)] + [(99, prose(rng, 200), *[None] * 8)]
    got = {r.doc_id: [(s.start, s.end) for s in r.spans] for r in suffixes.repeated_passages(frame(spark, some)).collect()}
    assert got.pop(99) == [] and set(map(tuple, got.values())) == {((30, 85),)}


def test_nulls_repeats_and_empty_tables(spark):
    assert suffixes.repeated_passages(frame(spark)).count() == len(rows())
    assert suffixes.repeated_passages(frame(spark, [])).count() == 0


def check_against_brute_force(spark, texts):
    some = [(i, t, *[None] * 8) for i, t in enumerate(texts)]
    got = {r.doc_id: covered(r) for r in suffixes.repeated_passages(frame(spark, some)).collect()}
    want = slow(dict(enumerate(texts)))
    assert all(sum(x) for x in want.values()) and {k for k in want if got[k] != want[k]} == set()


def test_pairs_that_share_more_of_a_common_passage(spark):
    import random

    rng = random.Random(11)
    common, texts = prose(rng, 45), []
    for _ in range(30):
        longer = prose(rng, 6)
        texts += [f"{prose(rng, 20)} {longer} {common} {prose(rng, 20)}" for _ in range(2)]
    check_against_brute_force(spark, texts)


def test_a_passage_many_times_in_one_text_and_once_in_another(spark):
    import random

    rng, texts = random.Random(12), []
    for _ in range(5):
        passage = prose(rng, 55)
        texts += [" ".join(f"{prose(rng, 9)} {passage}" for _ in range(20)), f"{prose(rng, 30)} {passage} {prose(rng, 30)}"]
    check_against_brute_force(spark, texts)
