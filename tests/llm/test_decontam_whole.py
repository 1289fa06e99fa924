import random
from itertools import combinations

from millrace.llm import decontam
from tests.llm.overlap import brute


def named(spark, docs, items):
    frame = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    return {(r.doc_id, i) for r in decontam.judged(frame, bench).collect() for i in r["items"] or []}


def test_clipped_runs_give_way_to_whole_ones(spark):
    schema = decontam.SEGMENTS
    for order in (1, -1):
        rows = [(1, 2, 7, [1, 2, 3], [5], [0]), (1, 2, 7, [1, 2, 3, 4, 5], [5, 6], [0, 2]), (1, 2, 9, [4], [8], [0])]
        got = decontam.longest_runs(spark.createDataFrame(rows[::order], schema).coalesce(1)).collect()
        assert sorted(map(tuple, got)) == [tuple(rows[1]), tuple(rows[2])]


def test_items_across_a_cut(spark):
    rng = random.Random(11)
    item = [f"q{rng.randrange(10**6):06d}" for _ in range(20)]
    # Words of 7 letters: the first piece of a text ends after 131,072 of them.
    docs = []
    for first in range(131072 - 24, 131072 + 4):
        words = ["w%06d" % rng.randrange(10**6) for _ in range(131072 + 300)]
        words[first:first + 20] = item
        docs.append(" ".join(words))
    assert named(spark, docs, [" ".join(item)]) == {(d, 0) for d in range(len(docs))}


def test_run_far_from_its_seed(spark):
    """Eight equal words, and the run that counts 60 words further on, without a seed of its own."""
    item = [f"t{k}" for k in range(120)]
    near = [f"u{k}" for k in range(120)]
    near[:8] = item[:8]
    far = list(near)
    far[80:93] = [w if k not in (2, 8) else f"u{k}" for k, w in enumerate(item[80:93])]
    assert named(spark, [" ".join(near), " ".join(far)], [" ".join(item)]) == {(1, 0)}


def test_no_overlap_is_without_a_seed():
    def fits(masks, e):
        return any(all(e[a + k] for k, b in enumerate(m) if b == "1") for m in masks for a in range(len(e) - len(m) + 1))

    for size in range(decontam.SHORTEST, 26):
        for gone in combinations(range(size), size // 5):
            assert fits(decontam._masks_of(size), [k not in gone for k in range(size)]), (size, gone)


def test_against_every_offset_without_seeds(spark):
    rng = random.Random(12)
    text = lambda n: [f"w{rng.randrange(400)}" for _ in range(n)]
    items = [text(n) for n in (3, 4, 5, 6, 8, 9, 10, 11, 12, 12, 13, 13, 14, 15, 15, 18, 20, 25, 40, 60, 0)]
    docs = []
    for k in range(400):
        item = list(items[k % 21])
        for at in rng.sample(range(len(item)), min(len(item), len(item) // 5 + rng.randrange(2))):
            item[at] = "z"
        docs.append(text(rng.randint(0, 30)) + (item[rng.randint(0, 2):] if k % 5 == 0 else item) + text(rng.randint(0, 30)))
    docs, items = [" ".join(d) for d in docs], [" ".join(i) for i in items]
    expected = brute(docs, items)
    assert len(expected) > 150
    assert named(spark, docs, items) == expected
