"""Token counts, token files, reply trees, mixing and the pipeline."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from chronolex.llm import edit_counts, mixing, pieces, queries, reply_trees, token_files
from chronolex.sources.scratch import fresh_path
from compare import difference, duck

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SMALL = "/root/testdata/sf0.01"


def table(spark, rows):
    """Rows of (doc_id, text, source)."""
    return spark.createDataFrame([(i, t, "en", s, 0) for i, t, s in rows], SCHEMA)


@pytest.fixture(scope="module")
def tokenizer():
    plain = Tokenizer.from_file(pieces.default_path())
    plain.encode_special_tokens = True
    return plain


def odd_texts(n=1500, seed=1):
    rng = random.Random(seed)
    fixed = [
        "", " ", "  a  b ", "a \nb\n c", "\n\n x", "it's  'll we 've", "日本 語 a", "x\x1c y", "<|endoftext|> a", "a\t b", "é à  ü",
        "a" * 500, "end ", "end\n", "\u00a0x \u2003y", "a \x85b", "word,\nNext. Word", "ab,.", "x" * 3000 + " y",
    ]
    made = ["".join(rng.choice(" \n\t'sabéß1.,日 \x1c") for _ in range(rng.randrange(60))) for _ in range(n)]
    return fixed + made + ["".join(rng.choice(" \nsabéß.,") for _ in range(rng.randrange(60))) for _ in range(n)]


# --- pieces and files -----------------------------------------------------------------------------


@pytest.mark.parametrize("remembered", [50, 600_000])
def test_pieces_give_the_ids_of_the_whole_text(tokenizer, remembered):
    encoder = pieces.PieceEncoder(pieces.default_path(), remembered)
    texts = odd_texts()
    for start in range(0, len(texts), 400):
        part = texts[start : start + 400]
        ids, tokens, chars, counts = encoder.encode(pa.array(part))
        ends = np.cumsum(counts)
        got = np.split(ids, np.cumsum(np.add.reduceat(tokens, ends - counts))[:-1])
        assert [g.tolist() for g in got] == [tokenizer.encode(t, add_special_tokens=False).ids for t in part]
        assert np.add.reduceat(chars, ends - counts).tolist() == [len(t) for t in part]


def test_token_files_round_trip(spark, tokenizer):
    texts = [*odd_texts(60), None]
    ids = [3 * i for i in range(len(texts) - 3)] + [None, 6, 6]
    docs = table(spark, [(i, t, "s") for i, t in zip(ids, texts)])
    folder = fresh_path(spark, "files")
    manifest = token_files.write(docs.withColumn("tie", F.lit(0)), folder, partitions=5)
    rows = token_files.read(manifest, folder).orderBy("start").collect()
    assert [r["doc_id"] for r in rows] == sorted(ids, key=lambda i: (i is not None, i))
    want = {}
    for i, t in zip(ids, texts):
        own = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], dtype="<u4")
        want.setdefault(i, []).append((len(own), zlib.crc32(own.tobytes())))
    got, start = {}, 0
    for r in rows:
        assert r["start"] == start
        start += r["n_tokens"]
        got.setdefault(r["doc_id"], []).append((r["n_tokens"], r["ids_crc32"]))
    assert {i: sorted(v) for i, v in got.items()} == {i: sorted(v) for i, v in want.items()}
    # The files themselves: one run of ids, the end id after each document.
    first = manifest.orderBy("base").first()
    flat = np.memmap(f"{folder.removeprefix('file://')}/{first['file']}.ids", dtype=f"<u{first['width']}", mode="r")
    offsets = np.fromfile(f"{folder.removeprefix('file://')}/{first['file']}.offsets", dtype="<u8")
    assert offsets[0] == 0 and offsets[-1] == len(flat) == first["tokens"] and (flat[offsets[1:].astype(int) - 1] == 0).all()
    empty = fresh_path(spark, "files")
    assert token_files.read(token_files.write(docs.limit(0), empty), empty).count() == 0


def test_token_query_equals_whole_encoding(spark, sf, tokenizer):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    start, want = 0, []
    for r in docs:
        own = np.array([*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 0], dtype="<u4")
        want.append((r["doc_id"], start, len(own), zlib.crc32(own.tobytes())))
        start += len(own)
    assert sorted(tuple(r) for r in queries.op6_token_files(spark, sf).collect()) == want


# --- edits ----------------------------------------------------------------------------------------


def test_edits_keep_counts_right(spark, tokenizer):
    rng = random.Random(9)
    bits = ["", " ", "\n", "  ", "word", " word", "é,", "\n\n", " a b", "日", "."]
    rows = []
    for k, text in enumerate([*odd_texts(150), "one two, three.\nFour five " * 60, None]):
        n = len(text or "")
        edits = [(rng.randint(-1, n + 2), rng.choice([0, 0, 1, 3, n // 3]), rng.choice(bits)) for _ in range(rng.randint(0, 6))]
        rows.append((k, text, edits if k % 9 else [(None, None, None)]))
    rows.append((10_000, "left alone", None))
    frame = spark.createDataFrame(rows, f"doc_id long, text string, edits {edit_counts.EDITS}").repartition(3)
    built = frame.withColumn("tree", edit_counts.build(F.col("text")))
    done = built.withColumn("after", edit_counts.apply_edits(F.col("text"), F.col("tree"), F.col("edits")))
    for r in done.collect():
        text = r["text"] or ""
        assert r["tree"]["sums"][1] == len(tokenizer.encode(text, add_special_tokens=False).ids)
        for edit in r["edits"] or []:
            pos = min(max(edit["pos"] or 0, 0), len(text))
            text = text[:pos] + (edit["added"] or "") + text[pos + max(edit["removed"] or 0, 0) :]
        assert r["after"]["text"] == text
        assert r["after"]["sums"][1] == len(tokenizer.encode(text, add_special_tokens=False).ids), (r, text)
        assert sum(r["after"]["leaf_chars"]) == len(text)
        sums = r["after"]["sums"]
        assert all(sums[i] == sums[2 * i] + sums[2 * i + 1] for i in range(1, len(sums) // 2))


def test_only_touched_regions_are_encoded(spark):
    text = " ".join(f"word{k}" for k in range(5000))
    row = spark.createDataFrame([(text, [(20_000, 3, "new")])], f"text string, edits {edit_counts.EDITS}")
    after = edit_counts.apply_edits(F.col("text"), edit_counts.build(F.col("text")), F.col("edits"))
    assert row.select(after.alias("a")).head()["a"]["encoded_chars"] < 1000


def test_edits_after_a_large_insertion_touch_little(spark, tokenizer):
    text = " ".join(f"word{k}" for k in range(300))
    large = " " + " ".join(f"more{k}" for k in range(20_000))
    edits = [(1000, 0, large), (50_000, 3, "new"), (120_000, 0, " x"), (900, 5, "y")]
    rows = spark.createDataFrame([(1, text, edits[:1]), (2, text, edits)], f"doc_id long, text string, edits {edit_counts.EDITS}")
    counts = {r["doc_id"]: r for r in edit_counts.edited_counts(rows).collect()}
    assert counts[2]["encoded_chars"] - counts[1]["encoded_chars"] < 2000
    for pos, removed, added in edits:
        text = text[:pos] + added + text[pos + removed :]
    assert counts[2]["n_tokens"] == len(tokenizer.encode(text, add_special_tokens=False).ids) and counts[2]["n_chars"] == len(text)


def test_trees_stay_right_through_many_edits(tokenizer):
    """Splitting, empty leaves and descent against plain sums."""
    rng = random.Random(4)
    texts = ["a b c d " * 40, "", "x" * 200]
    trees = [edit_counts.Tree.of(*own) for own in edit_counts._pieces(texts, pieces.default_path())]
    for _ in range(120):
        edits = [[{"pos": rng.randrange(len(t) + 1), "removed": rng.choice([0, 0, 2, 40]), "added": rng.choice(["", "w", " a b" * 60, "\n", "é "])}] for t in texts]
        texts, _ = edit_counts._edit(texts, trees, edits, pieces.default_path())
        for text, tree in zip(texts, trees):
            assert tree.sums[1] == len(tokenizer.encode(text, add_special_tokens=False).ids)
            assert tree.chars.sum() == tree.char_sums[1] == len(text)
            ends = np.cumsum(tree.chars)
            for pos in (0, len(text) // 2, max(len(text) - 1, 0), len(text)):
                leaf, start = tree._leaf(pos)
                want = min(int(np.searchsorted(ends, pos, side="right")), tree.leaves - 1)
                assert (leaf, start) == (want, int(ends[want] - tree.chars[want]))


def test_edited_counts_of_odd_rows(spark):
    schema = f"id string, body string, changes {edit_counts.EDITS}, _text int, tokens_before int, doc_id int"
    rows = [("a", "one two", [(0, 3, "three")], 1, 1, 1), ("a", "one two", None, 1, 1, 1), (None, None, [(5, 5, None)], 1, 1, 1), ("b", "", [], 1, 1, 1)]
    frame = spark.createDataFrame(rows, schema)
    got = edit_counts.edited_counts(frame, "id", "body", "changes")
    assert sorted(tuple(r)[:4] for r in got.collect() if r["id"]) == [("a", 2, 2, 7), ("a", 2, 2, 9), ("b", 0, 0, 0)]
    assert [tuple(r) for r in got.filter("id IS NULL").collect()] == [(None, 0, 0, 0, 0)]
    assert edit_counts.edited_counts(frame.limit(0), "id", "body", "changes").count() == 0


def test_edit_query_counts_equal_whole_encoding(spark, sf, tokenizer):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = queries.op5_edit_counts(spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        text, n = texts[r["doc_id"]], len(texts[r["doc_id"]])
        for pos, removed, added in ((n // 4, 6, f"edited-{r['doc_id']}"), (n // 2, 0, " and new words,"), (n * 3 // 4, 20, "")):
            text = text[:pos] + added + text[pos + removed :]
        assert r["tokens_before"] == len(tokenizer.encode(texts[r["doc_id"]], add_special_tokens=False).ids)
        assert r["n_tokens"] == len(tokenizer.encode(text, add_special_tokens=False).ids)
        assert r["n_chars"] == len(text)


# --- reply trees ----------------------------------------------------------------------------------


def test_escapes_are_reversible(spark):
    bits = ["\\", "b", "h", "t", "#", "##", "###", "</turn>", "</tur", "n>", "\n", ":", "c", "x", "### Assistant: "]
    rng = random.Random(3)
    texts = ["".join(rng.choices(bits, k=rng.randint(0, 8))) for _ in range(2000)]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    for codes in (reply_trees.TEXT_CODES, reply_trees.ROLE_CODES):
        hidden = reply_trees.escape(F.col("t"), codes)
        rows = frame.select("t", hidden.alias("e"), reply_trees.unescape(hidden, codes).alias("u")).collect()
        assert all(r["t"] == r["u"] and "###" not in r["e"] and "</turn>" not in r["e"] for r in rows)


def tree_rows():
    # Tree 1: root 1 with children 2 (score 1) and 3 (score 5); 4 below 2 (score 9), 5 and 6 below 3.
    return [
        (1, 1, None, "user", "root", 0.0), (1, 2, 1, "assistant", "two", 1.0), (1, 3, 1, "assistant", "three ###", 5.0),
        (1, 4, 2, "user", "four", 9.0), (1, 5, 3, "user", "five", 1.0), (1, 6, 3, "user", "six </turn>", 1.0),
        (2, 1, None, "user", "alone", None), (3, 1, 2, "user", "cycle", 1.0), (3, 2, 1, "user", "cycle", 1.0),
        (None, 1, None, "user", "nameless", 1.0), (None, 2, 1, "assistant", "child", 1.0), (4, 8, 99, "user", "orphan", 0.0),
    ]


def test_branches_are_ranked_by_score(spark):
    nodes = spark.createDataFrame(tree_rows(), "tree long, node long, parent long, role string, text string, score double")
    paths = {}
    for r in reply_trees.branches(nodes, per_tree=2).collect():
        paths.setdefault((r["tree"], r["branch"]), []).append((r["depth"], r["node"]))
    assert {k: [n for _, n in sorted(v)] for k, v in paths.items()} == {
        (1, 1): [1, 2, 4], (1, 2): [1, 3, 5], (2, 1): [1], (None, 1): [1, 2], (4, 1): [8],
    }
    formatted = {(r["tree"], r["branch"]): r for r in reply_trees.conversations(nodes, per_tree=3).select(
        "*", reply_trees.parse(F.col("formatted")).alias("turns"), reply_trees.trained_text(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()}
    assert [tuple(t) for t in formatted[1, 3]["turns"]] == [("user", "root"), ("assistant", "three ###"), ("user", "six </turn>")]
    assert formatted[1, 3]["loss"] == "three ###" and formatted[2, 1]["loss"] == ""


def test_long_chain_takes_few_rounds(spark):
    turns = spark.createDataFrame([(1, i, "assistant" if i % 2 else "user", f"t{i}") for i in range(300)], "conv_id long, turn long, role string, text string")
    row = reply_trees.conversations(reply_trees.reply_tree(turns)).select(reply_trees.parse(F.col("formatted")).alias("turns")).head()
    assert [t["text"] for t in row["turns"]] == [f"t{i}" for i in range(300)]


def test_conversations_odd_tables(spark):
    schema = "conv_id long, turn long, role string, text string, node int, depth int"
    rows = [(1, 0, None, None, 1, 1), (1, 0, "a:\n###", "", 1, 1), (1, None, "user", "x" * 100_000, 1, 1), (None, 1, "assistant", "y", 1, 1), (2, 1, "user", "same", 1, 1), (2, 1, "user", "same", 1, 1)]
    got = reply_trees.conversations(reply_trees.reply_tree(spark.createDataFrame(rows, schema)))
    turns = {r["tree"]: [tuple(t) for t in r["turns"]] for r in got.select("tree", reply_trees.parse(F.col("formatted")).alias("turns")).collect()}
    assert turns == {1: [("user", "x" * 100_000), ("", ""), ("a:\n###", "")], None: [("assistant", "y")], 2: [("user", "same")] * 2}
    assert reply_trees.conversations(reply_trees.reply_tree(spark.createDataFrame([], schema))).count() == 0


# --- mixing ---------------------------------------------------------------------------------------


def brute_targets(sizes, weights=mixing.WEIGHTS, most=mixing.MAX_REPEATS):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        rest = total - sum(fixed.values())
        share = {s: rest * weight[s] / sum(weight[f] for f in free) for s in free}
        over = [s for s in free if share[s] > most * sizes[s] + 1e-9]
        if not over:
            return fixed | share
        fixed |= {s: most * sizes[s] for s in over}


def check_mix(rows):
    sizes = {}
    for r in rows:
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
    want, taken, largest = brute_targets(sizes), {}, {}
    for r in rows:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]], rel=1e-9, abs=1e-6)
        assert 0 <= r["taken"] <= 3 * r["size"] and (not r["size"] or r["taken"] % r["size"] == 0)
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
        largest[r["source"]] = max(largest.get(r["source"], 0), r["size"])
    for s, t in taken.items():
        assert abs(t - want[s]) <= largest[s] / 2 + 1e-6, (s, t, want[s])


@pytest.mark.parametrize("seed", range(4))
def test_mix_meets_its_targets(spark, seed):
    rng = random.Random(seed)
    sources = ["src0", "src1", "src10", "é", "日", "", None][: 3 + seed]
    rows = [(i, " ".join(["w"] * rng.randint(0, 60)), rng.choice([sources[0], *sources])) for i in range(400)]
    check_mix(mixing.mixed(table(spark, rows)).collect())


def test_mixing_query(spark):
    rows = queries.op10_mixing(spark, SMALL).collect()
    check_mix(rows)
    words = {r["doc_id"]: len(r["text"].encode().split()) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    assert {r["doc_id"]: r["size"] for r in rows} == words
    assert sorted(tuple(r) for r in queries.op10_mixing(spark, SMALL).collect()) == sorted(tuple(r) for r in rows)


def test_mix_odd_tables(spark):
    odd = table(spark, [(1, None, "a"), (1, None, "a"), (None, "x y", None), (2, "", "b"), (3, "w " * 100_000, "b"), (3, "w " * 100_000, "b")])
    odd = odd.withColumns({"hash": F.lit(1), "copies": F.lit("c"), "bound": F.lit(2), "_source": F.lit(3)})
    check = mixing.mixed(odd).collect()
    assert len(check) == 6 and len({r["copies"] for r in check if r["doc_id"] == 3}) == 1
    mix = mixing.mix(odd)
    assert mix.columns == odd.columns and mix.count() == sum(r["copies"] for r in check)
    assert mixing.mixed(odd.limit(0)).count() == 0 and mixing.mix(odd.limit(0)).count() == 0
    assert {r["taken"] for r in mixing.mixed(odd.filter("doc_id = 1")).collect()} == {0}


def test_main_path_of_native_operators_has_no_python(spark, sf):
    from conftest import plan_of

    for query in (queries.op7_reply_trees, queries.op10_mixing):
        plan = plan_of(query(spark, sf))
        assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


# --- SQL and the pipeline ---------------------------------------------------------------------------


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, sf, name):
    assert difference(queries.QUERIES[name](spark, sf), duck(sf), queries.ORACLES[name]()) is None


def test_pipeline_stages(spark):
    """Each stage against what its operator says about its own input."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        path = fresh_path(spark, f"stage-{name}")
        stage(spark, docs, SMALL).write.parquet(path)
        after = spark.read.parquet(path)
        if name != "token_files":
            assert after.columns == columns
            before_ids, ids = ([r[0] for r in d.select("doc_id").collect()] for d in (docs, after))
            assert set(ids) <= set(before_ids) and (name == "mixing" or len(ids) == len(set(ids)) > 0.5 * len(before_ids))
        else:
            tokens = after.collect()
            assert len(tokens) == docs.count()
            assert sum(r["n_tokens"] for r in tokens) == max(r["start"] + r["n_tokens"] for r in tokens)
        if name == "near_duplicates":
            from test_near_copies import brute_near_copies

            label = brute_near_copies([(r["doc_id"], r["text"]) for r in docs.collect()])
            assert sorted(ids) == sorted(set(label.values()))
        docs = after


def test_pipeline_on_an_empty_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
    assert docs.count() == 0


def test_digest_of_turns(spark, sf):
    row = next(r for r in queries.op7_reply_trees(spark, sf).collect() if r["conv_id"] == -7)
    text = r"\### Assistant: </turn> ok"
    turns = "".join(f"{role}\n{text}\n" for role in ("user", "assistant"))
    assert row["n_turns"] == 2 and row["loss_chars"] == len(text)
    assert row["turns_sha256"] == hashlib.sha256(turns.encode()).hexdigest()
    assert row["loss_sha256"] == hashlib.sha256(text.encode()).hexdigest()
