"""Vector codes, whitening and sketches against brute force on small tables."""

import hashlib
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from chronolex.llm import codes, queries, sketches, whitening
from chronolex.llm.vectors import whole_vectors
from compare import difference, duck
from conftest import plan_of

SCHEMA = "vec_id long, embedding array<float>, label int, x string, id int, cell int"


def table(spark, rows, schema=SCHEMA):
    return spark.createDataFrame([(i, v, l, "x", 0, 1) for i, v, l in rows], schema)


def vectors(count, length, seed=1, spread=0.1):
    draw = np.random.default_rng(seed)
    return [[float(np.float32(c)) for c in row] for row in draw.normal(0, spread, (count, length))]


def brute_codes(rows, parts=8, entries=16, rounds=6, scale=4096):
    kept = [(i, [math.floor(scale * c) for c in v], l) for i, v, l in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    length = -(-max(len(x) for _, x, _ in kept) // parts) * parts
    kept = [(i, x + [0] * (length - len(x)), l) for i, x, l in kept]
    width = length // parts
    cut = lambda x, p: x[p * width : (p + 1) * width]
    distance = lambda a, b: sum((u - v) ** 2 for u, v in zip(a, b))
    ordered = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    books = [[cut(x, p) for _, x, _ in ordered[:entries]] for p in range(parts)]
    near = lambda x, p: min((distance(cut(x, p), e), k) for k, e in enumerate(books[p]))
    for _ in range(rounds):
        found = [[near(x, p)[1] for p in range(parts)] for _, x, _ in kept]
        for p in range(parts):
            for k in range(len(books[p])):
                mine = [cut(x, p) for (_, x, _), f in zip(kept, found) if f[p] == k]
                if mine:
                    books[p][k] = [sum(c) // len(mine) for c in zip(*mine)]
            # entries move only after all parts of the round are assigned
    out, by_label = [], {}
    for i, x, l in kept:
        own = [near(x, p) for p in range(parts)]
        out.append((i, "".join(f"{k:02x}" for _, k in own), sum(d for d, _ in own), l))
        by_label[l] = by_label.get(l, 0) + out[-1][2]
    digest = hashlib.sha256(",".join(str(c) for book in books for e in book for c in e).encode()).hexdigest()
    return sorted(((i, code, error, by_label[l], digest) for i, code, error, l in out), key=repr)


def got_codes(df, **more):
    return sorted((tuple(r) for r in codes.compress(df, **more).collect()), key=repr)


ODD = [(90, None, 1), (91, [0.0] * 15 + [None], 1), (92, [0.0] * 15 + [float("nan")], 2), (93, [float("inf")] + [0.0] * 15, 2)]


def test_codes_equal_brute_force(spark):
    made = vectors(60, 16)
    rows = [(i, v, [None, 1, 2][i % 3]) for i, v in enumerate(made)]
    # Repeated ids, equal vectors, a NULL id, exact ties between entries.
    rows += [(3, made[5], 1), (3, made[3], 1), (None, made[7], None), (61, [0.0] * 16, 2), (62, [0.0] * 16, 2), (63, [-0.0] * 16, 2)]
    assert got_codes(table(spark, rows + ODD)) == brute_codes(rows)


def test_codes_of_few_short_and_uneven_vectors(spark):
    rows = [(1, [0.5, -0.25, 0.1], None), (2, [0.5], 3), (3, [], 3), (4, [0.5, -0.25, 0.1, 7.0, 1.0, 1.0, 1.0, 1.0, 2.0], 3)]
    assert got_codes(table(spark, rows)) == brute_codes(rows)
    assert got_codes(table(spark, [(1, [], None)]))[0][1:3] == ("00" * 8, 0)
    assert got_codes(table(spark, [])) == []
    assert got_codes(table(spark, ODD)) == []


def test_codes_with_string_ids_and_labels(spark):
    rows = [(str(i), v, None if i % 2 else "a") for i, v in enumerate(vectors(30, 8))]
    df = table(spark, rows, "vec_id string, embedding array<double>, label string, x string, id int, cell int")
    got = codes.compress(df).collect()
    assert len(got) == 30 and len({r["label_error"] for r in got}) == 2


@pytest.mark.parametrize("count,width", [(1, 1), (5, 3), (16, 8), (64, 4), (70, 2), (200, 5)])
def test_slices_find_the_nearest_entry(count, width):
    draw = np.random.default_rng(count)
    entries = draw.integers(-9, 9, (count, width))  # many equal coordinates and ties
    x = draw.integers(-12, 12, (500, width))
    distance = ((x[:, None] - entries[None]) ** 2).sum(axis=2)
    found, least = codes.Slices(entries).nearest(x)
    assert (found == distance.argmin(axis=1)).all() and (least == distance.min(axis=1)).all()
    radius = draw.integers(0, 9, 500)
    masks = codes.Slices(entries).within(x, radius)
    inside = (np.abs(x[:, None] - entries[None]) <= radius[:, None, None]).all(axis=2)
    bits = np.unpackbits(masks.view(np.uint8), axis=1, bitorder="little")[:, :count]
    assert (bits.astype(bool) == inside).all()


def test_codes_do_not_depend_on_partitions(spark):
    rows = [(i, v, i % 4) for i, v in enumerate(vectors(80, 8))]
    df = table(spark, rows)
    assert got_codes(df.repartition(1)) == got_codes(df.repartition(13))


def brute_whitening(rows, scale=256, components=4):
    kept = [(i, [math.floor(scale * c) for c in v]) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([v for _, v in kept], dtype=float)
    fit = np.unique(x, axis=0)
    n, mean = len(fit), fit.mean(axis=0)
    values, columns = np.linalg.eigh((fit - mean).T @ (fit - mean) / n)
    values, columns = values[::-1], columns[:, ::-1]
    s = [int(v) for v in fit.sum(axis=0)]
    deviation = [sum((n * int(c) - t) ** 2 for c, t in zip(v, s)) for v in x]
    k = min(components, int((values > 1e-9 * values[0]).sum()))
    return kept, n, deviation, (x - mean) @ columns[:, :k] / np.sqrt(values[:k]), values[:k] / values.sum()


def check_whitening(spark, rows, **more):
    got = whitening.whitened(table(spark, [(i, v, 0) for i, v in rows]), **more).collect()
    kept, n, deviation, want, explained = brute_whitening(rows, components=more.get("components", 4))
    k = want.shape[1]
    assert len(got) == len(kept) * k and {r["n"] for r in got} == {n}
    assert len({r["identity_error"] for r in got}) == 1 and got[0]["identity_error"] < 1e-9
    for c in range(k):
        mine = [r for r in got if r["component"] == c + 1]
        by_row = sorted((repr(r["vec_id"]), r["deviation"], r["whitened"]) for r in mine)
        sign = np.sign(np.dot([r[2] for r in by_row], [w for _, _, w in sorted((repr(i), d, w) for (i, _), d, w in zip(kept, deviation, want[:, c]))]) or 1)
        wanted = sorted((repr(i), d, sign * w) for (i, _), d, w in zip(kept, deviation, want[:, c]))
        assert [r[:2] for r in by_row] == [r[:2] for r in wanted]
        assert np.allclose([r[2] for r in by_row], [r[2] for r in wanted], atol=1e-8)
        assert abs(mine[0]["explained"] - explained[c]) < 1e-12


def test_whitening_equals_eigenvectors(spark):
    draw = np.random.default_rng(3)
    made = draw.normal(0, 0.1, (200, 12)) * np.linspace(3, 1, 12) + 5
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(made)]
    rows += [(i, rows[0][1]) for i in range(300, 400)] + [(None, rows[1][1]), (2, rows[3][1])]
    check_whitening(spark, rows + [(i, v) for i, v, _ in [(90, None, 1), (91, [float("nan")] * 12, 1), (92, [None] * 12, 1)]])


def test_whitening_of_a_flat_spectrum_and_of_low_rank(spark):
    check_whitening(spark, list(enumerate(vectors(300, 6, seed=4))))
    low = np.random.default_rng(5).integers(-50, 50, (60, 2)) @ np.array([[1, 0, 2, 0, 1], [0, 3, 0, 1, 1]])
    check_whitening(spark, [(i, [float(c) / 256 for c in v]) for i, v in enumerate(low)])
    check_whitening(spark, list(enumerate([[0.5], [0.25], [0.5]])))


def test_whitening_without_variance_gives_no_rows(spark):
    assert whitening.whitened(table(spark, [])).count() == 0
    assert whitening.whitened(table(spark, [(1, [1.0, 2.0], 0), (2, [1.0, 2.0], 0)])).count() == 0
    assert whitening.whitened(table(spark, [(1, [], 0)])).count() == 0


def test_whitening_of_large_components(spark):
    rows = [(1, [1e12, 0.0], 0), (2, [-1e12, 1.0], 0), (3, [1e30, 0.0], 0)]
    got = whitening.whitened(table(spark, rows), components=1).collect()
    assert sorted(r["vec_id"] for r in got) == [1, 2]  # 256e30 is no long
    assert {r["deviation"] for r in got} == {None} and got[0]["identity_error"] < 1e-6


def test_whole_vectors_fill_with_zeros(spark):
    stored, length = whole_vectors(table(spark, [(1, [1.0], 0), (2, [1.0, 2.0, 3.0], 0)]), "vec_id", "embedding", {}, 1, 100.0, 2)
    assert length == 4 and sorted(r["x"] for r in stored.collect()) == [[1, 0, 0, 0], [1, 2, 3, 0]]


WORDS = re.compile("[^\x20\x09-\x0d]+")


def brute_sketch(text, scale=16, width=5):
    words = WORDS.findall((text or "").lower())
    if not words:
        return []
    hashes = {hashlib.md5(" ".join(words[i : i + width]).encode()).hexdigest()[:16] for i in range(max(1, len(words) - width + 1))}
    return sorted(h for h in hashes if int(h, 16) < 2**64 / scale) or [min(hashes)]


def documents(spark, rows):
    return spark.createDataFrame([(i, t, 0, "h") for i, t in rows], "doc_id long, text string, id int, hash string")


def brute_edits(rows):
    ordered = sorted(rows, key=lambda r: -r[0])
    out = []
    for k, (i, t) in enumerate(ordered):
        text, following = t or "", ordered[(k + 1) % len(ordered)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        a, b, c = (set(brute_sketch(x)) for x in (text, edited, following))
        near = [len(a & o) / len(a | o) if a | o else 1.0 for o in (b, c)]
        within = [len(a & o) / len(a) if a else 1.0 for o in (b, c)]
        digests = ["".join(sorted(x)) for x in (a, b)]
        out.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), *digests, *near, *within))
    return sorted(out)


def texts(count, seed=2):
    draw = random.Random(seed)
    some = ["été", "The", "the", "a", "日本", "x" * 40, "word", "𝄞", "Ünder"]
    return ["".join(draw.choice(some) + draw.choice([" ", "\n", "\t ", "\x0b", " "]) for _ in range(draw.choice([0, 1, 3, 4, 5, 6, 40, 300]))) for _ in range(count)]


def test_edits_equal_brute_force(spark):
    rows = list(enumerate([None, "", " \n", *texts(60), "a b c d e", "a b c d e", " "]))
    got = sorted(tuple(r) for r in sketches.near_edits(documents(spark, rows)).collect())
    assert got == brute_edits(rows)


@pytest.mark.parametrize("chunk_rows", [1, 7])
def test_edits_over_many_chunks(spark, chunk_rows):
    rows = [(5 * i, t) for i, t in enumerate(texts(30, seed=5))]
    made = sketches.with_edits(documents(spark, rows), chunk_rows=chunk_rows).select("doc_id", "edited_sha256")
    assert sorted(tuple(r) for r in made.collect()) == [(r[0], r[2]) for r in brute_edits(rows)]


def test_edits_of_repeated_and_null_ids(spark):
    rows = [(1, "a b c d e f g h"), (2, "q r s t u v w x")] + [(2, "a b c d e f g h")] * 40 + [(None, "z"), (None, None), (None, None)]
    got = sketches.near_edits(documents(spark, rows)).collect()
    assert sorted(repr(r["doc_id"]) for r in got) == sorted(repr(i) for i, _ in rows)
    copies = [r for r in got if r["doc_id"] == 2 and r["n_chars"] == 15]
    assert sum(r["near_next"] == 1.0 for r in copies) >= 39  # each copy but the last has a copy after it
    one = sketches.near_edits(documents(spark, [(7, "a b c d e")])).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0
    assert sketches.near_edits(documents(spark, [])).count() == 0


def test_edits_with_string_ids(spark):
    df = spark.createDataFrame([("q1", "a b"), ("q2", None), (None, "c")], "doc_id string, text string")
    assert sorted(repr(r["doc_id"]) for r in sketches.near_edits(df).collect()) == ["'q1'", "'q2'", "None"]


def test_sketches_merge_and_estimate_containment(spark):
    draw = random.Random(9)
    big = " ".join(f"w{draw.randrange(10**6)}" for _ in range(20_000))
    small = " ".join(big.split()[5_000:6_000])
    rows = [(1, big, small), (2, "a b c", "a b c d e f"), (3, "", "x y"), (4, None, None)]
    df = spark.createDataFrame(rows, "n int, first string, second string")
    a, b = sketches.sketch(F.col("first")), sketches.sketch(F.col("second"))
    got = {
        r["n"]: r
        for r in df.select("n", a.alias("a"), b.alias("b"), sketches.merge(a, b).alias("m"), sketches.containment(b, a).alias("c"), sketches.hashes(sketches.fingerprint(a)).alias("h")).collect()
    }
    for n, first, second in rows:
        assert got[n]["a"] == got[n]["h"] == brute_sketch(first) and got[n]["b"] == brute_sketch(second)
        both = set(brute_sketch(first)) | set(brute_sketch(second))
        assert got[n]["m"] == (sorted(h for h in both if h < "1") or sorted(both)[:1])
    assert got[1]["c"] == 1.0 and len(got[1]["a"]) > 1_000


def test_sketches_are_native(spark, sf):
    plan = plan_of(queries.QUERIES["op12_sketches"](spark, sf))
    assert not re.search("Python|Pandas|Arrow", plan)


@pytest.mark.parametrize("name", ["op11_vector_codes", "op12_sketches"])
def test_queries_equal_sql(spark, sf, name):
    assert difference(queries.QUERIES[name](spark, sf), duck(sf), queries.ORACLES[name]()) is None
