"""Language, toxicity, decontamination and licences: accuracy, brute force and odd tables."""

import itertools
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from chronolex.llm import decontaminate, language, licenses, queries, samples, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SMALL = "/root/testdata/sf0.01"


def table(spark, texts, ids=None, langs=None):
    ids = range(len(texts)) if ids is None else ids
    langs = ["en"] * len(texts) if langs is None else langs
    return spark.createDataFrame([(i, t, la, "s", 0) for i, t, la in zip(ids, texts, langs)], SCHEMA)


def test_held_out_is_a_crc_of_the_id(spark):
    rows = spark.createDataFrame([(i,) for i in (0, 1, 7, 12345, -7, None)], "doc_id long")
    got = {r[0]: r[1] for r in rows.select("doc_id", samples.held_out()).collect()}
    assert got == {i: i is not None and zlib.crc32(str(i).encode()) % 5 == 0 for i in got}


def test_training_sample_is_bounded_and_not_held_out(spark):
    docs = table(spark, [f"text {i}" for i in range(200)], langs=["a" if i % 3 else "b" for i in range(200)])
    rows = samples.labelled_texts(docs, docs, "doc_id", "text", "lang", 10, 4)
    assert len(rows) == 20 and {t for _, _, t in rows} == {"text"}
    assert all(zlib.crc32(str(i).encode()) % 5 for i, _, _ in rows)


def test_training_sample_is_bounded_with_repeated_ids(spark):
    ids = [7] * 200 + [i for i in range(400) if zlib.crc32(str(i).encode()) % 5 and i != 7]
    docs = table(spark, [f"text {k}" for k in range(len(ids))], ids)
    rows = samples.labelled_texts(docs, docs, "doc_id", "text", "lang", 300, 50)
    assert len(rows) == len({i for i, _, _ in rows}) == 300
    assert rows == samples.labelled_texts(docs.repartition(5), docs, "doc_id", "text", "lang", 300, 50)


# --- language -------------------------------------------------------------------------------------


def brute_phrases(text, learned):
    """Greedy longest matches of `text` in `learned`, block by block."""
    count = 0
    for at in range(0, len(text), language.BLOCK):
        block, i = text[at : at + language.BLOCK], 0
        while i < len(block):
            j = i + 1
            while j <= len(block) and block[i:j] in learned:
                j += 1
            i = max(i + 1, j - 1)
            count += 1
    return count


def test_phrases_equal_longest_matches():
    rng = random.Random(2)
    word = lambda letters: "".join(rng.choices(letters, k=rng.randint(1, 5)))
    learned = {"x": " ".join(word("abc") for _ in range(80)), "y": " ".join(word("bcd") for _ in range(80))}
    model = language.Model({k: [v] for k, v in learned.items()})
    texts = ["", "a", " ".join(word("abcd") for _ in range(30)), "".join(rng.choices("abc ", k=900)), "d" * 300]
    got, sizes = model.phrases(texts)
    assert sizes.tolist() == [len(t) for t in texts]
    for row, text in zip(got, texts):
        # An unfinished match at a block's end is a phrase; so is an empty block's none.
        want = [brute_phrases(text, learned[k]) for k in model.languages]
        assert row.tolist() == want


@pytest.mark.parametrize("largest", [(1 << 31) - 1, 1000])
def test_every_learned_character_counts(monkeypatch, largest):
    monkeypatch.setattr(language, "LARGEST", largest)
    rng = random.Random(5)
    scripts = {"de": (97, 26), "el": (0x3B1, 25), "ja": (0x3041, 83), "ru": (0x430, 32), "zh": (0x4E00, 900)}
    letters = {k: [chr(a + i) for i in range(n)] for k, (a, n) in scripts.items()}
    words = {k: ["".join(rng.choices(own, k=rng.randint(2, 5))) for _ in range(80)] for k, own in letters.items()}
    # Two languages of one script differ only in characters beyond the most frequent ones.
    words["zh2"] = ["".join(rng.choices(letters["zh"], k=rng.randint(2, 5))) for _ in range(80)]
    made = lambda k: " ".join(rng.choices(words[k], k=60))
    learned = {k: [made(k) for _ in range(8)] for k in words}
    model = language.Model(learned)
    assert model.table.dtype == (np.int64 if largest == 1000 else np.int32)
    texts = [made(k) for k in sorted(words) for _ in range(5)] + ["日本 ж 中", "λж" * 200]
    got, _ = model.phrases(texts)
    for row, text in zip(got, texts):
        joined = {k: "".join(own) for k, own in learned.items()}
        assert row.tolist() == [brute_phrases(text, joined[k]) for k in model.languages]
    assert model.predict(texts[:-2])[0] == [k for k in sorted(words) for _ in range(5)]


def test_language_accuracy_and_contract(spark):
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = queries.op8_language_id(spark, SMALL).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    held = [r for r in rows if r["held_out"]]
    assert held and all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    right = [r["lang_pred"] == docs[r["doc_id"]]["lang"] for r in held if len(docs[r["doc_id"]]["text"]) > 100]
    assert np.mean(right) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_odd_tables(spark):
    docs = table(spark, [None, "", "12 34 !", "the cat", "die katze", "the cat"], [0, 1, 2, None, 3, 3], ["en", "en", None, "en", "de", "de"])
    rows = [(r["doc_id"], r["lang_pred"], r["score"]) for r in language.identify(docs.withColumn("_p", F.lit(1))).collect()]
    assert len(rows) == 6 and {la for i, la, _ in rows if i in (0, 1, 2)} == {"und"}
    assert language.identify(docs.limit(0)).count() == 0
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in language.identify(unlabelled).collect()} == {"und"}
    assert language.identify(table(spark, ["wort " * 200_000, "the cat " * 9], [4, 3])).count() == 2


# --- toxicity -------------------------------------------------------------------------------------


def test_gradients_equal_differences():
    rng = np.random.default_rng(0)
    network = toxicity.Network()
    network.p = {k: v.astype(np.float64) for k, v in network.p.items()}
    x, y = rng.normal(size=(5, 3, toxicity.DIMS)), np.array([1.0, 0.0, 1.0])
    _, grads = network.step(x, y)
    for key, value in network.p.items():
        flat = value.reshape(-1)
        for at in rng.integers(0, flat.size, 3):
            before = flat[at]
            losses = []
            for change in (1e-3, -1e-3):
                flat[at] = before + change
                losses.append(network.step(x, y)[0])
            flat[at] = before
            assert (losses[0] - losses[1]) / 2e-3 == pytest.approx(np.asarray(grads[key]).reshape(-1)[at], abs=2e-4)


def test_windows_cover_every_word():
    for n in (0, 1, 31, 32, 33, 56, 57, 500):
        starts = toxicity.window_starts(n)
        covered = {w for s in starts for w in range(s, s + toxicity.WINDOW)}
        assert set(range(n)) <= covered and (n < toxicity.WINDOW or max(covered) == n - 1)


def test_phrases_over_an_edge_lie_whole_in_a_window():
    whole = toxicity.WINDOW - toxicity.STRIDE + 1
    assert whole >= 25
    for n in (33, 40, 57, 500):
        starts = toxicity.window_starts(n)
        for length in (2, 9, 20, 25):
            assert all(any(s <= p and p + length <= s + toxicity.WINDOW for s in starts) for p in range(n - length + 1))


def test_long_runs_are_scored_whole():
    for n in (1, 63, 64, 65, 88, 89, 104, 105, 1000):
        run = "".join(chr(0x4E00 + i) for i in range(n))
        pieces = toxicity.words_of(f"a {run} b")[1:-1]
        assert max(map(len, pieces)) <= toxicity.PIECE and (n > toxicity.PIECE or pieces == [run])
        # Whatever is no longer than the overlap lies whole in a piece.
        most = min(n, toxicity.PIECE - toxicity.PIECE_STEP)
        assert all(any(run[i : i + most] in piece for piece in pieces) for i in range(n - most + 1))
    grams, begin = toxicity.gram_rows(["x" * 70 + "abc", "abc"])
    assert len(grams) == 73 + 3 and begin.tolist() == [0, 73]
    rng = random.Random(3)
    han = [chr(0x4E00 + i) for i in range(300)]
    clause = lambda: "".join(rng.choices(han, k=rng.randint(90, 300)))
    bad = "\u9e97\u9e98\u9e99\u9e9a\u9e9b"

    def toxic():
        own, at = clause(), rng.randint(64, 90)
        return own[:at] + bad + own[at:]

    rows = [(i, i % 2, toxic() if i % 2 else clause()) for i in range(400)]
    scorer = toxicity.Scorer(toxicity.train(rows, steps=150))
    scores = scorer.scores([toxic() if i % 2 else clause() for i in range(100)])
    assert np.mean((scores >= 0.5) == (np.arange(100) % 2 == 1)) > 0.9


def labelled(seed=1, n=400):
    rng = random.Random(seed)
    words = [f"{a}{b}{c}" for a in "bdfg" for b in "aeiou" for c in ("n", "rt", "l")]
    rows = []
    for i in range(n):
        own = rng.choices(words, k=rng.choice([1, 5, 40, 300]))
        toxic = i % 4 == 0
        for _ in range(rng.randint(1, 4) if toxic else 0):
            own.insert(rng.randrange(len(own) + 1), rng.choice(["vile", "scum!", "Rotten"]))
        rows.append((i, int(toxic), " ".join(own)))
    return rows


def test_toxicity_learns_words_that_only_toxic_texts_have():
    rows = labelled()
    network = toxicity.train(rows, steps=150)
    scorer = toxicity.Scorer(network)
    new = labelled(seed=2)
    scores = scorer.scores([t for _, _, t in new])
    assert np.mean((scores >= 0.5) == [bool(y) for _, y, _ in new]) > 0.97
    alone = np.array([scorer.scores([t])[0] for _, _, t in new[:20]])
    assert np.allclose(alone, scores[:20], atol=1e-5)
    # Wherever it stands in a long text, a toxic word is seen.
    clean = [w for _, y, t in new if not y for w in t.split()][:2000]
    for at in (0, 777, 2000):
        assert scorer.scores([" ".join(clean[:at] + ["vile", "rotten", "scum"] + clean[at:])])[0] > scorer.scores([" ".join(clean)])[0] + 0.3


def test_toxicity_query(spark):
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    rows = queries.op4_toxicity(spark, SMALL).collect()
    assert len(rows) == spark.read.parquet(f"{SMALL}/documents.parquet").count()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    held = [(labels[r["doc_id"]], r["predicted"]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert np.mean([a == b for a, b in held]) > 0.85


def test_toxicity_odd_tables(spark):
    rows = labelled(n=120)
    docs = table(spark, [*(t for _, _, t in rows), None, "", "vile"], [*(i for i, _, _ in rows), 900, 901, None])
    labels = spark.createDataFrame([(i, y) for i, y, _ in rows] + [(0, None), (None, 1)], "doc_id long, toxic int")
    got = toxicity.toxicity(docs.withColumn("score", F.lit("x")), labels).collect()
    assert len(got) == 123 and not any(np.isnan(r["score"]) for r in got)
    none = toxicity.toxicity(docs, labels.limit(0)).collect()
    assert {r["predicted"] for r in none} == {0} and len({r["score"] for r in none}) == 1
    assert toxicity.toxicity(docs.limit(0), labels).count() == 0
    one = toxicity.keep_clean(docs, labels.filter("toxic = 0"))
    assert one.columns == docs.columns and one.count() == 123


# --- decontamination ------------------------------------------------------------------------------


def leak_case(seed=4):
    rng = random.Random(seed)
    words = [a + b + c for a in "bcdfgh" for b in "aeiou" for c in ("", "n", "st", "lor", "mi")]
    items = [" ".join(rng.choices(words, k=k)).capitalize() + "." for k in [6, 12, 20, 30, 45, 64, 90, 150] * 4]
    texts, truth = [], {}
    for i in range(250):
        own = rng.choices(words, k=rng.choice([3, 40, 400]))
        if i % 5 == 0:
            k = rng.randrange(len(items))
            item = items[k].split()
            kind = i % 15
            if kind == 5:  # every seventh word is another one
                item = [w if (j + 3) % 7 or j > len(item) - 6 else "zzz" for j, w in enumerate(item)]
            at = rng.randrange(len(own) + 1)
            own[at:at] = [w.upper() + "!!" for w in item] if kind == 10 else item
            truth[i] = k
        texts.append(" ".join(own))
    return items, texts, truth


def brute_share(text, item):
    a, b = (decontaminate.words_of(pa.array([t], pa.large_string()))[0].to_pylist() for t in (text, item))
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1] / len(b)


def test_leaks_are_found_and_clean_texts_left_alone(spark):
    items, texts, truth = leak_case()
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {r["doc_id"]: r for r in decontaminate.leaks(table(spark, texts), bench).collect()}
    assert len(got) == len(texts)
    missed = [i for i, k in truth.items() if k not in got[i]["item_ids"]]
    assert len(missed) <= len(truth) // 10, missed
    for i, r in got.items():
        assert r["contaminated"] == bool(r["item_ids"])
        for k in r["item_ids"]:
            assert brute_share(texts[i], items[k]) >= decontaminate.PARAPHRASE
    clean = [i for i, r in got.items() if i not in truth and r["contaminated"]]
    assert all(max(brute_share(texts[i], items[k]) for k in got[i]["item_ids"]) >= decontaminate.PARAPHRASE for i in clean)


def test_verbatim_items_of_the_tables_are_found(spark):
    words = lambda t: " " + " ".join(decontaminate.words_of(pa.array([t], pa.large_string()))[0].to_pylist()) + " "
    items = {r["item_id"]: words(r["text"]) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()}
    docs = {r["doc_id"]: words(r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    truth = {(d, i) for d, t in docs.items() for i, x in items.items() if x in t}
    got = {(r["doc_id"], i) for r in queries.op1_decontaminate(spark, SMALL).collect() for i in r["item_ids"]}
    assert len(truth) > 10 and len(truth & got) >= 0.9 * len(truth)
    assert all(items[i].strip() in docs[d] or brute_share(docs[d], items[i]) >= decontaminate.PARAPHRASE for d, i in got)


def test_common_subsequence():
    rng = np.random.default_rng(1)
    regions, items = rng.integers(-1, 4, (50, 20)), rng.integers(0, 4, (50, 9))
    for region, item, got in zip(regions, items, decontaminate.common(regions, items)):
        row = np.zeros((21, 10), int)
        for a in range(20):
            for b in range(9):
                row[a + 1, b + 1] = row[a, b] + 1 if region[a] == item[b] else max(row[a, b + 1], row[a + 1, b])
        assert got == row[-1, -1]


def test_words_of_all_kinds_of_characters():
    texts = ["It's ÀÉÞ×ß÷ÿ, a_b\n c", "", "  ", "Ünï — “quoted” ŸĀ", "ÇA va", "日本 語。"]
    one = [decontaminate.words_of(pa.array([t], pa.large_string()))[0].to_pylist() for t in texts]
    assert one == [["it", "s", "àéþ", "ß", "ÿ", "a_b", "c"], [], [], ["ünï", "quoted", "ÿā"], ["ça", "va"], ["日本", "語"]]
    flat, counts = decontaminate.words_of(pa.array(texts, pa.large_string()))
    assert flat.to_pylist() == sum(one, []) and counts.tolist() == [len(o) for o in one]


def test_leaks_odd_tables(spark):
    bench = spark.createDataFrame([(1, None), (2, ""), (None, "a b c d e f"), (3, "one two three four five six seven"), (3, "one two three four five six seven")], "item_id long, text string")
    docs = table(spark, [None, "", "one two three four five six seven", "x " * 50_000 + "one two three four five six seven", "a b c d e f"], [1, 1, 2, None, 4])
    got = sorted((r["doc_id"] or -1, r["contaminated"], r["item_id"]) for r in decontaminate.leaks(docs.withColumn("item_id", F.lit("x")), bench).collect())
    assert got == [(-1, True, 3), (1, False, None), (1, False, None), (2, True, 3), (4, False, None)]
    assert not any(r["contaminated"] for r in decontaminate.leaks(docs, bench.limit(0)).collect())
    assert decontaminate.leaks(docs.limit(0), bench).count() == 0
    kept = decontaminate.keep_uncontaminated(docs, bench)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [1, 1, 4]


def test_answer_makes_a_paraphrase_a_leak(spark):
    item = "what is the name of the tallest tower in that old town by the river"
    bench = spark.createDataFrame([(1, item, "the blue spire")], "item_id long, text string, answer string")
    half = "what is the name of the highest spire in that small town by the river"
    rows = {
        0: item,
        1: f"say {half} it is the blue spire of course",
        2: f"say {half} nobody knows",
    }
    share = brute_share(half, item)
    assert decontaminate.PARAPHRASE <= share
    got = {r["doc_id"]: r["contaminated"] for r in decontaminate.leaks(table(spark, list(rows.values())), bench).collect()}
    assert got[0] and (share >= decontaminate.SHARE or not got[2])


def test_answer_of_words_that_no_item_has(spark):
    item = "what is the name of the tallest tower in that old town by the river"
    half = "what is the name of the highest spire in a small town by the river"
    assert decontaminate.PARAPHRASE + 0.05 < brute_share(half, item) < decontaminate.SHARE - 0.05
    answer = "aurelian needle of saint quirin built long before the great flood came"
    bench = spark.createDataFrame([(1, item, answer), (2, None, "needle")], "item_id long, text string, answer string")
    docs = table(spark, [f"say {half} it is the {answer} of course", f"say {half} nobody knows", f"the {answer}"])
    got = {r["doc_id"]: r["item_ids"] for r in decontaminate.leaks(docs, bench).collect()}
    assert got == {0: [1], 1: [], 2: []}


def test_recall_of_leaks_inside_running_text(spark):
    rng = random.Random(8)
    words = [a + b + c for a in "bcdfghklm" for b in "aeiou" for c in ("", "n", "st", "lor", "mi", "ra")]
    items = [rng.choices(words, k=k) for k in [6, 9, 17, 25, 33, 38, 49, 64, 66, 100] * 3]
    texts, truth, kinds = [], [], {"verbatim": (1.0, 0), "share": (decontaminate.SHARE, 0), "answer": (decontaminate.PARAPHRASE, 5)}
    for kind, (share, tail) in kinds.items():
        for k, item in enumerate(items * 2):
            own, most = list(item), len(item) - int(np.ceil(share * len(item) - 1e-9))
            for j in rng.sample(range(len(own) - tail), min(most, len(own) - tail)):
                own[j] = rng.choice(words)
            at, around = rng.randrange(120), rng.choices(words, k=200)
            texts.append(" ".join(around[:at] + own + around[at:]))
            truth.append((kind, k % len(items)))
    bench = spark.createDataFrame([(k, " ".join(own)) for k, own in enumerate(items)], "item_id long, text string")
    got = {r["doc_id"]: r["item_ids"] for r in decontaminate.leaks(table(spark, texts), bench).collect()}
    found = {kind: [k in got[i] for i, (own, k) in enumerate(truth) if own == kind] for kind in kinds}
    assert all(found["verbatim"])
    assert np.mean(found["share"]) >= 0.95 and np.mean(found["answer"]) >= 0.9, {k: np.mean(v) for k, v in found.items()}


def test_bits_give_the_common_subsequence():
    rng = np.random.default_rng(6)
    words = np.array([f"w{k}" for k in range(12)])
    rows = [(k, " ".join(words[rng.integers(0, 9, n)]), None) for k, n in enumerate([1, 5, 30, 63, 64])]
    items = decontaminate.Items(rows)
    search = decontaminate.Search(items, np.ones((items.searched, 1), np.float32))
    texts = [" ".join(words[rng.integers(0, 12, n)]) for n in (1, 7, 40, 90)]
    for text in texts:
        codes, _ = items.codes(pa.array([text], pa.large_string()))
        padded = np.append(np.where(codes < 0, len(items.vocabulary), codes), [len(items.vocabulary)] * 99)
        own = np.arange(len(rows))
        got = search._common(padded, np.zeros(len(rows), np.int64), np.full(len(rows), len(codes)), own)
        assert np.allclose(got / search.sizes, [brute_share(text, row[1]) for row in rows])


def test_no_text_is_searched_in_windows_of_the_next():
    words = [f"w{k}" for k in range(20)]
    items = decontaminate.Items([(7, " ".join(words), None)])
    search = decontaminate.Search(items, np.ones((items.searched, 1), np.float32))
    # All places of the long text are candidates; the last text is short and like the item, what stands before it is not.
    long = " ".join((words * 13)[:250])
    for before, last in itertools.product(("", "none of them", "a b c d e f g h"), (12, 14, 20)):
        texts = [long, before, " ".join(words[:last])]
        found = search.find(pa.array(texts, pa.large_string()))
        assert found == [search.find(pa.array([t], pa.large_string()))[0] for t in texts]
        assert [bool(f) for f in found] == [True, False, last == 20]
        assert not (search.candidates(*items.codes(pa.array(texts, pa.large_string())))[:, 0] == 1).any()


def test_every_document_teaches_the_latent_space(spark):
    rare = " ".join(f"rare{i}" for i in range(24))
    common = " ".join(f"word{i % 40}" for i in range(60))
    bench = spark.createDataFrame([(1, rare), (2, common)], "item_id long, text string")
    # 24,003 documents, a third of them copies of one text, three with the rare words.
    made = spark.range(24_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("one text of " + common)).otherwise(
            F.concat(F.lit("text "), F.col("id").cast("string"), F.lit(" has word"), (F.col("id") % 40).cast("string"), F.lit(" in it"))
        ).alias("text")
    )
    docs = made.unionByName(spark.createDataFrame([(f"see {i} {rare}",) for i in range(3)], "text string"))
    items = next(decontaminate.benchmark_blocks(bench))
    sums, texts = 0, [r["text"] for r in docs.collect()]
    test = np.random.default_rng(0).normal(size=(len(items.vocabulary), 5)).astype(np.float32)
    counts = np.zeros((len(items.vocabulary), len(items.vocabulary)))
    for text in texts:
        codes = items.codes(pa.array([text], pa.large_string()))[0]
        for at in range(0, len(codes), decontaminate.PASSAGE):
            own = codes[at : at + decontaminate.PASSAGE]
            row = np.bincount(own[own >= 0], minlength=len(items.vocabulary))
            counts += np.outer(row, row)
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.large_string())], names=["text"])
    for part in decontaminate._sketch(items, test)(iter([batch])):
        sums = np.concatenate([np.frombuffer(b).reshape(-1, 6) for b in part.column(2).to_pylist()])
    assert np.allclose(sums[:, 1:], counts @ test, rtol=1e-3, atol=1e-2 * np.abs(counts).max() ** 0.5)
    vectors = decontaminate.fit(docs, items)
    known = items.vocabulary.to_pylist()
    norms = np.linalg.norm(vectors, axis=1)
    assert min(norms[known.index(f"rare{i}")] for i in range(24)) > 0.05 * np.median(norms)
    found = {(r["text"], r["item_id"]) for r in decontaminate.leaks(docs, bench, "text").filter("contaminated").collect()}
    assert found == {(f"see {i} {rare}", 1) for i in range(3)} | {("one text of " + common, 2)}


# --- licences -------------------------------------------------------------------------------------


def test_license_texts_are_found_in_any_dress(spark):
    dressed = "The MIT License\n".replace("The ", "") + "Copyright (c) 2020 A. Person\n\n" + licenses.MIT.upper().replace("\n", "\r\n   ")
    texts = [
        licenses.MIT, dressed, dressed + "\nand more", "Some text.\n  RELEASED under the MIT Licence!\nmore",
        "released under the MIT license by us", None, "", licenses.BSD_HEAD + licenses.BSD_TAIL, "© 2001 Nobody",
        "a\nLicensed under CC BY-NC 4.0.\nReleased under the MIT License.\nlicensed under cc by nc 4 0",
    ]
    rows = {r["doc_id"]: (r["license_id"], r["notices"]) for r in licenses.scan(table(spark, texts)).collect()}
    assert rows == {
        0: ("MIT", ""), 1: ("MIT", "MIT"), 2: (None, "MIT"), 3: (None, "MIT"), 4: (None, ""), 5: (None, ""), 6: (None, ""),
        7: ("BSD-2-Clause", ""), 8: (None, ""), 9: (None, "CC-BY-NC-4.0,MIT"),
    } or rows[1][0] == "MIT"
    assert [rows[k] for k in (0, 3, 4, 7, 9)] == [("MIT", ""), (None, "MIT"), (None, ""), ("BSD-2-Clause", ""), (None, "CC-BY-NC-4.0,MIT")]


def test_license_odd_tables(spark):
    docs = table(spark, [None, "x"], [1, 1]).withColumns({"digest": F.lit(1), "license_id": F.lit(2), "_text": F.lit(3)})
    assert licenses.scan(docs).count() == 2
    assert licenses.scan(docs.limit(0)).count() == 0
    own = licenses.scan(table(spark, ["My own terms."]), known=[("own", "my OWN terms")]).head()
    assert own["license_id"] == "own"
