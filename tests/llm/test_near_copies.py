"""Near copies at a 5-word similarity of 0.8 against brute force over all pairs that share a shingle."""

import collections
import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from chronolex.llm import near_copies as nc
from chronolex.llm.samples import labelled_texts
from chronolex.llm.simhash import keep_one as keep_one_by_few_bits

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def table(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], SCHEMA)


def shingles(text, width=5):
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))) if words else frozenset()


def brute_pairs(sets, similarity=0.8):
    """Pairs of positions whose sets have the similarity."""
    holders = collections.defaultdict(list)
    for k, own in enumerate(sets):
        for s in own:
            holders[s].append(k)
    shared = collections.Counter(p for own in holders.values() for p in itertools.combinations(own, 2))
    return [(a, b) for (a, b), n in shared.items() if n >= similarity * (len(sets[a]) + len(sets[b]) - n)]


def brute_near_copies(rows, similarity=0.8):
    """Smallest id of each row's component, by id."""
    by_set = collections.defaultdict(list)
    for i, t in rows:
        by_set[shingles(t)].append(i)
    sets = list(by_set)
    label = [min(by_set[s]) for s in sets]
    pairs, changed = brute_pairs(sets, similarity), True
    while changed:
        changed = False
        for a, b in pairs:
            if label[a] != label[b]:
                label[a] = label[b] = min(label[a], label[b])
                changed = True
    return {i: label[k] for k, s in enumerate(sets) for i in by_set[s]}


def edited(rng, text, edits):
    words = text.split(" ")
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def some_rows(seed, bases=40):
    rng = random.Random(seed)
    rows = []
    for _ in range(bases):
        text = " ".join(f"w{rng.randrange(2000)}" for _ in range(rng.choice([6, 30, 100, 250, 700])))
        rows.append(text)
        rows += [edited(rng, text, rng.randrange(1 + max(1, len(text.split(" ")) // 40))) for _ in range(rng.randrange(4))]
    rows += ["one", "ONE", "one two", None, "", " \n\t", "é è ê ë ē", "É è ê ë ē"]
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("seed,tile", [(1, 1024), (2, 3)])
def test_near_copies_equal_brute_force(spark, seed, tile):
    rows = some_rows(seed)
    got = {r["doc_id"]: r["component_id"] for r in nc.near_copies(table(spark, rows), tile=tile).collect()}
    want = brute_near_copies(rows)
    assert got == want and len(set(want.values())) < 0.8 * len(rows)


def test_recall_of_near_copies(spark):
    """Pairs of one base each, so that each link stands alone; 0.95 of those at 0.8 or more, and none below."""
    rng = random.Random(8)
    rows = []
    for k in range(150):
        text = " ".join(f"b{k}x{rng.randrange(5000)}" for _ in range(120 + k))
        rows += [(2 * k, text), (2 * k + 1, edited(rng, text, 1 + k % 7))]
    sets = [shingles(t) for _, t in rows]
    true = set(brute_pairs(sets))
    got = dict(tuple(r) for r in nc.near_copies(table(spark, rows)).collect())
    linked = {(2 * k, 2 * k + 1) for k in range(150) if got[2 * k] == got[2 * k + 1]}
    assert linked <= true and len(true) > 60 and len(linked) >= 0.95 * len(true)


def test_large_group_of_near_copies_over_many_tiles(spark):
    rng = random.Random(4)
    text = " ".join(f"w{rng.randrange(3000)}" for _ in range(200))
    rows = [(i, edited(rng, text, 2)) for i in range(150)] + [(1000 + i, " ".join(f"c{i}v{k}" for k in range(50))) for i in range(30)]
    kept = nc.keep_one(table(spark, rows))
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(brute_near_copies(rows).values()))
    small = {r["doc_id"]: r["component_id"] for r in nc.near_copies(table(spark, rows), tile=16).collect()}
    assert small == brute_near_copies(rows)


def test_bounds_lie_around_the_mean():
    sure, limit = nc.distance_bounds(0.8)
    bits = 64 * nc.LANES
    assert 0 < sure < 0.1515 * bits < limit < 0.2 * bits
    rng = np.random.default_rng(3)
    for _ in range(30):
        own = rng.integers(0, 1 << 63, 500).astype(np.uint64)
        other = own.copy()
        other[:56] = rng.integers(0, 1 << 63, 56).astype(np.uint64)  # similarity 0.7986
        a, b = (nc.long_fingerprint(np.unique(s)) for s in (own, other))
        assert sure < np.bitwise_count(a ^ b).sum() < limit


def test_odd_tables(spark):
    assert nc.near_copies(table(spark, []).limit(0)).count() == 0
    assert nc.keep_one(table(spark, []).limit(0)).count() == 0
    rows = [(4, "a b c d"), (2, "A b c d"), (3, None), (1, ""), (None, "zz yy xx"), (None, "a b c d"), (7, "q"), (7, "r")]
    clash = {c: F.lit(1) for c in ("id", "node", "print", "key", "component_id", "_kept", "_id", "_label", "copies")}
    docs = table(spark, rows).withColumns(clash)
    kept = nc.keep_one(docs)
    assert sorted(kept.columns) == sorted(docs.columns)
    assert sorted(r["doc_id"] or -1 for r in kept.collect()) == [-1, -1, 1, 2, 7, 7]
    assert sorted(r["doc_id"] or -1 for r in keep_one_by_few_bits(docs).collect()) == [-1, -1, 1, 2, 7, 7]
    texts = table(spark, []).select(F.lit("x").alias("doc_id"), "text").unionByName(
        spark.createDataFrame([("k2", "a b"), ("k1", "a b"), ("k3", "c")], "doc_id string, text string")
    )
    assert sorted(r["doc_id"] for r in nc.keep_one(texts).collect()) == ["k1", "k3"]


def test_samples_with_clashing_columns(spark):
    docs = table(spark, [(i, f"text {i}") for i in range(40)]).withColumns({c: F.lit(0) for c in ("_id", "_label", "_text", "_rank")})
    labels = docs.select("doc_id", (F.col("doc_id") % 3).alias("toxic"), F.lit(1).alias("_id"))
    got = labelled_texts(docs, labels, "doc_id", "text", "toxic", 5, 6)
    assert len(got) == 15 and {label for _, label, _ in got} == {0, 1, 2} and all(t == f"text {i}"[:6] for i, _, t in got)


def test_chance_meetings_grow_no_faster_than_nodes():
    """Expected meetings of unrelated nodes, and the chance of a pair at 0.8 to share a block, at any number of nodes."""
    share, rng = nc.differing_share(0.8), np.random.default_rng(5)
    meetings, found = {}, {}
    for nodes in (50_000, 200_000, 800_000):
        places = nc.block_places(nodes, 0.8)
        assert all(len(set(p)) == places.shape[1] for p in places)
        meetings[nodes] = len(places) * nodes**2 / 2.0 ** places.shape[1]
        differ = rng.random((600, 64 * nc.LANES)) < share
        found[nodes] = np.mean([not differ[i][places].any(axis=1).all() for i in range(len(differ))])
    assert meetings[200_000] < 8 * meetings[50_000] and meetings[800_000] < 8 * meetings[200_000]  # 16 by the square
    assert min(found.values()) > 0.96 and nc.block_places(0, 0.8).shape == (139, 22)


def test_same_components_with_wider_blocks(spark, monkeypatch):
    rows = some_rows(3)
    monkeypatch.setattr(nc, "BLOCK_NODES", 10)
    assert nc.block_places(len(rows), 0.8).shape[1] > nc.BLOCK
    got = {r["doc_id"]: r["component_id"] for r in nc.near_copies(table(spark, rows)).collect()}
    assert got == brute_near_copies(rows)
