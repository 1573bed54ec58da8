import random

import pytest

from lexloom.llm import similar
from tests.llm.cases import frame, prose
from tests.llm.test_pipeline import alike, shingles
from tests.llm.test_simhash import components


def edited(rng, text, edits):
    words = text.split()
    for i in rng.sample(range(len(words)), edits):
        words[i] = f"edit{rng.randrange(10**9)}"
    return " ".join(words)


def texts():
    """Pairs on both sides of the limit, a passage that many share, and a group of many near copies."""
    rng, out = random.Random(21), []
    for i in range(60):
        base = prose(rng, 300)
        out += [base, edited(rng, base, 4 + i % 5)]
    common = prose(rng, 60)
    out += [f"{prose(rng, 20)} {common} {prose(rng, 20)}" for _ in range(40)]
    base = prose(rng, 200)
    return out + [edited(rng, base, 2) for _ in range(50)]


def groups(some):
    sets = [shingles(t) for t in some]
    return components(list(range(len(some))), lambda a, b: alike(sets[a], sets[b]) >= 0.8)


def test_deduplicate_equals_brute_force_near_the_limit(spark):
    some = texts()
    want = set(groups(some).values())
    got = similar.deduplicate(frame(spark, [(i, t, *[None] * 8) for i, t in enumerate(some)])).select("doc_id").collect()
    assert sorted(r.doc_id for r in got) == sorted(want)


@pytest.mark.parametrize("limit", [4096, 3])
def test_groups_do_not_depend_on_how_candidates_are_dealt(spark, monkeypatch, limit):
    for name, value in (("JOIN_FROM", 2 if limit == 3 else 10**6), ("JOIN_LIMIT", 5), ("SAMPLE", 1), ("OFTEN", 3 if limit == 3 else 10**6)):
        monkeypatch.setattr(similar, name, value)
    some = texts()
    found = similar.similar_documents(frame(spark, [(i, t, *[None] * 8) for i, t in enumerate(some)]), bucket_limit=limit)
    assert {r.doc_id: r.component_id for r in found.collect()} == groups(some)


def test_deduplicate_keeps_each_group_of_rows_without_an_id_and_of_one_id(spark):
    rng = random.Random(4)
    a, b, c, x, y = (prose(rng, 30) for _ in range(5))
    some = [(None, a), (None, b), (None, b), (None, c), (7, c), (1, x), (1, y), (5, y), (9, None), (None, "")]
    got = similar.deduplicate(frame(spark, [(i, t, *[None] * 8) for i, t in some])).select("doc_id", "text").collect()
    assert sorted(map(tuple, got), key=str) == sorted([(None, a), (None, b), (7, c), (1, x), (1, y), (9, None)], key=str)


def test_deduplicate_keys_only_texts_whose_id_does_not_name_one_row(spark):
    some = [(None, "a b"), (7, "c d"), (7, "e f"), *[(i, f"{i} text") for i in range(10, 30)]]
    plan = similar.deduplicate(frame(spark, [(i, t, *[None] * 8) for i, t in some]))._jdf.queryExecution().executedPlan().toString()
    # a key's filter moved below the joins would run on every text, beside the column's own run: two workers a task
    assert "EvalPython" not in plan
