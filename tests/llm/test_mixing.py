import hashlib
import math
import random
import re
from collections import defaultdict

from pyspark.sql import functions as F

from lexloom.llm import mixing
from tests.llm.cases import frame, rows


def slow_targets(sizes):
    names = sorted([s for s in sizes if s is not None]) + [None] * (None in sizes)
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    budget, target, open_ = 1.5 * sum(sizes.values()), dict.fromkeys(names, 0.0), set(names)
    while open_:
        share = budget / sum(weight[s] for s in open_)
        over = [s for s in open_ if share * weight[s] >= 2 * sizes[s]]
        if not over:
            return target | {s: share * weight[s] for s in open_}
        for s in over:
            target[s] = 2.0 * sizes[s]
            budget -= target[s]
            open_.discard(s)
    return target


def unit(text):
    return int(hashlib.md5(f"42:{text}".encode()).hexdigest()[:13], 16) / 2**52


def slow_copies(some):
    """Copies of each (doc_id, text, size, source) row, in order, and the sources' targets and sizes."""
    sizes = defaultdict(int)
    for _, _, size, source in some:
        sizes[source] += size
    targets = slow_targets(sizes)
    numbers = [unit(f"null:{hashlib.md5((t or '').encode()).hexdigest()}" if i is None else i) for i, t, _, _ in some]
    copies = [0] * len(some)
    for s in sizes:
        rate = targets[s] / sizes[s] if sizes[s] else 0.0
        wanted, left = rate % 1 * sizes[s], float(sizes[s])
        classes = defaultdict(list)
        for row, (_, _, n, source) in enumerate(some):
            if source == s:
                classes[len(str(n)), str(n).ljust(2, "0")[:2]].append(row)
        for (digits, lead), members in sorted(classes.items(), reverse=True):
            share = min(max(wanted / left, 0), 1) if left else rate % 1
            drawn = math.floor(len(members) * share + unit(f"{'null' if s is None else s}:{digits * 100 + int(lead)}"))
            words = sum(some[m][2] for m in members)
            wanted, left = wanted - drawn * words / len(members), left - words
            for m in members:
                copies[m] = int(rate) + (sum(numbers[x] < numbers[m] for x in members) < drawn)
    return copies, targets, sizes


def words(text):
    return len(re.findall("[^\x20\x09-\x0d]+", text or ""))


def test_plan_equals_the_slow_definition(spark):
    some = [(r[0], r[1], words(r[1]), r[3]) for r in rows()]
    copies, targets, _ = slow_copies(some)
    plan = mixing.mix_plan(frame(spark)).collect()
    assert sorted((str(r.doc_id), r.size, r.copies) for r in plan) == sorted((str(i), n, c) for (i, _, n, _), c in zip(some, copies))
    assert all(abs(r.target - targets[r.source]) < 1e-6 and r.copies <= 2 for r in plan)


def test_hot_classes_and_totals_near_their_targets(spark):
    rng = random.Random(8)
    some = [(i if i % 3 else None, "w " * int(rng.paretovariate(1.1) * 20), "en", "ab"[i % 2], 0, *[None] * 5) for i in range(1500)]
    some += [(7, "x y z", "en", "a", 0, *[None] * 5)] * 40
    want, targets, sizes = slow_copies([(r[0], r[1], words(r[1]), r[3]) for r in some])
    got = mixing.mix_plan(frame(spark, some)).collect()
    assert sorted((str(r.doc_id), r.size, r.copies) for r in got) == sorted((str(r[0]), words(r[1]), c) for r, c in zip(some, want))
    for s in "ab":
        assert abs(sum(r.size * r.copies for r in got if r.source == s) - targets[s]) < 0.02 * targets[s]


def test_every_document_is_drawn_as_often_as_its_rate(spark):
    some = [(i, "w " * (3 + i * i % 97), "en", "a", 0, *[None] * 5) for i in range(12)] + [(99, "w " * 300, "en", "b", 0, *[None] * 5)]
    table, total = frame(spark, some).cache(), defaultdict(int)
    for seed in range(8):
        for r in mixing.mix_plan(table, share=1.25, seed=seed).filter("source = 'a'").collect():
            total[r.doc_id] += r.copies
    rate = mixing.mix_plan(table, share=1.25).filter("source = 'a'").select((F.col("target") / F.col("source_size")).alias("r")).first().r
    assert abs(sum(total.values()) / 8 / 12 - rate) < 0.15


def test_mix_repeats_rows_as_planned(spark):
    copies = defaultdict(int)
    for r in mixing.mix_plan(frame(spark)).collect():
        copies[r.doc_id] += r.copies
    out = mixing.mix_sources(frame(spark))
    assert out.columns == frame(spark).columns
    got = defaultdict(int)
    for r in out.collect():
        got[r.doc_id] += 1
    assert dict(got) == {k: v for k, v in copies.items() if v}


def test_empty_and_wordless_tables(spark):
    assert mixing.mix_plan(frame(spark, [])).count() == 0 and mixing.mix_sources(frame(spark, [])).count() == 0
    none = [(1, None, "en", "a", 0, *[None] * 5), (2, "", "en", None, 0, *[None] * 5)]
    assert [(r.size, r.target, r.copies) for r in mixing.mix_plan(frame(spark, none)).collect()] == [(0, 0.0, 0)] * 2
