"""Exact and near duplicates against brute force."""

import hashlib
import itertools
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from chronolex.llm import components, exact_dedup, queries, simhash

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WHITE = re.compile("[\x20\x09-\x0d]")


def table(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, "en", "s", 0) for i, t in zip(ids, texts)], SCHEMA)


def brute_exact(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(WHITE.sub("", t or ""), []).append((-len(t or ""), i))
    out = []
    for i, t in rows:
        bare = WHITE.sub("", t or "")
        keep = min(groups[bare])[1]
        out.append((i, keep, len(groups[bare]), i == keep, hashlib.sha256(bare.encode()).hexdigest()))
    return sorted(out)


TEXTS = [
    None, "", " \n\t", "a", "a ", "ab", "a b", "a b", "abc" * 50, "abc" * 50 + "d", "abc" * 50 + " d", "x" * 5000,
    "x" * 5000 + " ", "x" * 4999 + "y", "é", "é", "日本", "日 本", "a", "ab\x0b", "\x1c", "x" * 64, "x" * 64, "x" * 64 + "z",
]


@pytest.mark.parametrize("first,growth", [(1, 2), (2, 3), (64, 8)])
def test_exact_groups_equal_brute_force(spark, first, growth):
    rows = list(enumerate(TEXTS))
    grouped = exact_dedup.exact_groups(table(spark, TEXTS), first_digit=first, growth=growth).collect()
    same = {}
    for r in grouped:
        if r["grp"] is not None:
            same.setdefault(r["grp"], set()).add(r["id"])
    want = {}
    for i, t in rows:
        want.setdefault(WHITE.sub("", t or ""), set()).add(i)
    assert sorted(map(sorted, same.values())) == sorted(sorted(g) for g in want.values() if len(g) > 1)
    assert len(grouped) == len(rows)


def test_exact_duplicates_equal_brute_force(spark):
    got = sorted(tuple(r) for r in exact_dedup.exact_duplicates(table(spark, TEXTS)).collect())
    assert got == brute_exact(list(enumerate(TEXTS)))


def test_exact_duplicates_odd_tables(spark):
    assert exact_dedup.exact_duplicates(table(spark, ["a"]).limit(0)).count() == 0
    repeated = exact_dedup.exact_duplicates(table(spark, ["a", "a", "b", "a"], [1, 1, 1, None])).collect()
    assert sorted((r["doc_id"] is None, r["group_size"], r["keep_id"], r["kept"]) for r in repeated) == [
        (False, 1, 1, True), (False, 3, 1, True), (False, 3, 1, True), (True, 3, 1, False),
    ]
    clash = table(spark, ["a", "a"]).withColumns({c: F.lit(0) for c in ("id", "grp", "rest", "digit", "keep_id", "points")})
    assert exact_dedup.exact_duplicates(clash).filter("kept").count() == 1


def brute_fingerprint(text, width=3):
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, distance=3):
    label = {i: i for i in prints}
    while True:
        new = {i: min(label[j] for j in prints if (prints[i] ^ prints[j]).bit_count() <= distance) for i in prints}
        if new == label:
            return label
        label = new


def some_texts(seed=3, n=60):
    rng = random.Random(seed)
    words = [f"w{k}É" for k in range(300)]
    base = [" ".join(rng.choices(words, k=rng.choice([1, 2, 3, 5, 200, 400]))) for _ in range(n // 3)]
    near = []
    for t in base * 2:
        own = t.split(" ")
        own[rng.randrange(len(own))] = "other"
        near.append(" ".join(own).upper() if rng.random() < 0.3 else " \n".join(own))
    return [*base, *near, None, "", "  \t", "ONE", "one"]


def test_near_duplicates_equal_brute_force(spark):
    texts = some_texts()
    prints = {i: brute_fingerprint(t) for i, t in enumerate(texts)}
    label = brute_components(prints)
    got = {r["doc_id"]: r for r in simhash.near_duplicates(table(spark, texts)).collect()}
    assert {i: int(r["fingerprint"], 16) for i, r in got.items()} == prints
    assert all(len(r["fingerprint"]) == 16 for r in got.values())
    assert {i: r["component_id"] for i, r in got.items()} == label
    assert len(set(label.values())) < len(label)


def test_long_text_is_hashed_in_slices(monkeypatch):
    text = " ".join(random.Random(1).choices("abcdefgh", k=500))
    whole = simhash._fingerprint(text, 3)
    monkeypatch.setattr(simhash, "SLICE_SHINGLES", 7)
    assert simhash._fingerprint(text, 3) == whole == simhash._signed(brute_fingerprint(text))


@pytest.mark.parametrize("tile", [4, 512])
def test_links_connect_what_is_near(spark, tile):
    rng = np.random.default_rng(5)
    values = {0, (1 << 64) - 1}
    for center in rng.integers(0, 1 << 63, 4):
        for _ in range(40):
            near = int(center)
            for bit in rng.integers(0, 64, rng.integers(0, 5)):
                near ^= 1 << int(bit)
            values.add(near)
    prints = {v: v for v in values}
    want = {frozenset(g) for g in _classes(brute_components(prints)) if len(g) > 1}
    rows = spark.createDataFrame([(simhash._signed(v),) for v in values], "fp long")
    found = components.connected_components(simhash.links(rows, tile=tile)).collect()
    got = {}
    for r in found:
        got.setdefault(r["component"], set()).add(r["node"] % (1 << 64))
    assert {frozenset(g) for g in got.values()} == want


def _classes(label):
    out = {}
    for i, c in label.items():
        out.setdefault(c, set()).add(i)
    return out.values()


def test_masks_cover_all_close_pairs():
    masks = simhash.block_masks(3, 3)
    assert len(masks) == 20
    for bits in itertools.combinations(range(0, 64, 3), 3):
        difference = sum(1 << b for b in bits)
        assert any(mask & difference == 0 for mask in masks)


def test_components_of_a_long_chain(spark):
    chain = [(i, i + 1) for i in range(1, 200)] + [(500, 501), (501, 500), (7, 7), (900, 900)]
    got = {r["node"]: r["component"] for r in components.connected_components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(1, 201)}, 500: 500, 501: 500}


def test_near_duplicates_odd_tables(spark):
    assert simhash.near_duplicates(table(spark, ["a"]).limit(0)).count() == 0
    odd = simhash.near_duplicates(table(spark, ["a b c d", "a b c d", "q"], [5, 5, None])).collect()
    assert sorted((r["doc_id"] or -1, r["component_id"] or -1) for r in odd) == [(-1, -1), (5, 5), (5, 5)]
    docs = table(spark, ["a b c d", "A b c d", None, "", "zz yy xx"], [4, 2, 3, 1, None])
    kept = simhash.keep_one(docs.withColumn("fp", F.lit(1)))
    assert kept.columns == [*docs.columns, "fp"]
    assert sorted((r["doc_id"] or -1) for r in kept.collect()) == [-1, 1, 2]


def test_queries_equal_brute_force(spark, sf):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    exact = sorted(tuple(r) for r in queries.op2_exact_dedup(spark, sf).collect())
    assert exact == brute_exact(docs)
    prints = {i: brute_fingerprint(t) for i, t in docs}
    near = {r["doc_id"]: r["component_id"] for r in queries.op9_simhash(spark, sf).collect()}
    assert near == brute_components(prints)
