"""Every registered query of the subpackage, and the pipeline, over small tables with nulls, ties and empty texts, against plain Python."""

import base64
import hashlib
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from cairnspark.llm import catalog, digest, pieces, simhash, token_counts
from cairnspark.llm.tokens import default_vocabulary, encoding

SAYING = "\\### Assistant: </turn> ok"
LONG = " ".join(f"word{i % 997}" for i in range(20_000))
CLEAN = [" ".join(f"w{(i * 31 + k * 17) % 4001}" for k in range(60)) + "." for i in range(40)]
TEXTS = [*CLEAN, CLEAN[0], CLEAN[0] + " more", None, "", " \n", "<|endoftext|> and 漢字。", LONG, "a b c d e f g h " * 9]
PAGES = [(i, f"http://h.example/{i}", f"<body><ul><li><a>m {i}</a><li><a>n</a></ul><article><h1>T {i}</h1><p>text &amp; {i}</p></article><footer>f</footer></body>") for i in range(6)]
PAGES += [(10, None, None), (11, "x", ""), (12, "http://h.example/c", PAGES[0][2]), (12, "http://h.example/c", PAGES[0][2])]
CHATS = [(1, 2, "assistant", "b"), (1, 1, "user", "a"), (1, 3, "assistant", None), (2, 1, "a</turn>\nb:%#", "x\n### y"), (2, 1, "a</turn>\nb:%#", "x\n### y"), (3, 1, None, SAYING * 3), (1, 4, "assistant", "é\n" * 50)]
_DRAWN = np.random.default_rng(5).normal(0, 0.12, (230, 8)).astype(np.float32).tolist()
VECTORS = [(i, v if i % 9 else _DRAWN[0], i % 4, 1, "clash") for i, v in enumerate(_DRAWN)]  # every ninth is the same vector
VECTORS += [(1000, None, 1, 0, ""), (1050, _DRAWN[3], None, 0, ""), (1100, [float("nan"), *_DRAWN[1][1:]], 1, 0, ""), (1150, [None, *_DRAWN[1][1:]], 1, 0, ""), (1200, [float("inf"), *_DRAWN[1][1:]], 1, 0, "")]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("tables"))
    docs = [(i, t, "en", "s", 0, "clash", 1) for i, t in enumerate(TEXTS)]
    labels = [(i, 1, int(i % 3 == 0)) for i in range(30)] + [(1, 1, None), (None, 1, 1)]
    for name, rows, schema in (
        ("documents", docs, "doc_id long, text string, lang string, source string, n_chars long, key string, fp int"), ("labels", labels, "doc_id long, quality int, toxic int"),
        ("embeddings", VECTORS, "vec_id long, embedding array<float>, label int, row int, leaf string"), ("pages", PAGES, "page_id long, url string, html string"), ("conversations", CHATS, "conv_id long, turn long, role string, text string")):
        spark.createDataFrame(rows, schema).write.parquet(f"{d}/{name}.parquet")
        spark.createDataFrame([], schema).write.parquet(f"{d}/none/{name}.parquet")
    return d


def rows_of(spark, folder, name):
    return catalog.QUERIES[name](spark, folder).collect()


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_empty_tables(spark, folder, name):
    assert len(rows_of(spark, f"{folder}/none", name)) == (1 if name == "op1_chat" else 0)


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_sql(spark, folder, name):
    c = duckdb.connect()
    for t in ("documents", "embeddings", "labels", "pages", "conversations"):
        c.sql(f"create view {t} as select * from '{folder}/{t}.parquet/*.parquet'")
    frame = catalog.QUERIES[name](spark, folder)
    want = c.sql(catalog.ORACLE_SQL[name])
    order = [want.columns.index(x) for x in frame.columns]
    assert sorted(str(tuple(r)) for r in frame.collect()) == sorted(str(tuple(r[i] for i in order)) for r in want.fetchall())


def test_chat(spark, folder):
    got = {r["conv_id"]: r for r in rows_of(spark, folder, "op1_chat")}
    for conv in (1, 2, 3, -7):
        turns = [(0, "user", SAYING), (1, "assistant", SAYING)] if conv == -7 else sorted((t, r or "", x or "") for c, t, r, x in CHATS if c == conv)
        learned = "".join(x for _, r, x in turns if r == "assistant")
        assert got[conv]["n_turns"] == len(turns) and got[conv]["loss_chars"] == len(learned)
        assert got[conv]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in turns).encode()).hexdigest()
        assert got[conv]["loss_sha256"] == hashlib.sha256(learned.encode()).hexdigest()


def test_warc(spark, folder):
    for r in rows_of(spark, folder, "op2_warc"):
        body = next(h or "" for i, _, h in PAGES if i == r["page_id"]).encode()
        first = max(i for i, _, h in PAGES if (h or "").encode() == body)
        assert r["payload_bytes"] == len(body) and r["payload_digest"] == base64.b32encode(hashlib.sha1(body).digest()).decode()
        assert (r["record_type"], r["refers_to"]) == (("response", None) if first == r["page_id"] else ("revisit", first))


def test_toxicity(spark, folder):
    rows = rows_of(spark, folder, "op3_toxicity")
    assert len(rows) == len(TEXTS)
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and r["predicted"] == int(r["score"] >= 0.3) and 0 <= r["score"] <= 1


def test_simhash(spark, folder):
    import xxhash

    def plain(t):
        words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        for c in "\t\n\x0b\x0c\r":
            words = words.replace(c, " ")
        words = [w for w in words.split(" ") if w]
        if not words:
            return 0
        parts = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)]
        hashes = [xxhash.xxh64(p.encode(), seed=42).intdigest() for p in parts]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))

    prints = [plain(t) for t in TEXTS]
    parent = list(range(len(TEXTS)))
    for _ in TEXTS:
        parent = [min(parent[j] for j in range(len(TEXTS)) if bin(prints[i] ^ prints[j]).count("1") <= 3) for i in range(len(TEXTS))]
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in rows_of(spark, folder, "op5_simhash")}
    assert got == {i: (f"{p:016x}", parent[i]) for i, p in enumerate(prints)} and simhash.SHINGLE == 3


def test_fingerprints(spark, folder):
    got = {r["doc_id"]: r for r in rows_of(spark, folder, "op7_fingerprints")}
    for i, t in enumerate(TEXTS):
        t, after = t or "", TEXTS[i - 1] or ""
        edited = t[: len(t) - len(t) // 2] + after[: len(t) // 2]
        r = got[i]
        assert (r["n_chars"], r["edited_sha256"]) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert (r["fingerprint"], r["edited_fingerprint"]) == (digest.digest(t), digest.digest(edited))
        assert r["near_next"] == pytest.approx(digest.likeness(digest.digest(t), digest.digest(after)))


def test_quality(spark, folder):
    got = {r["doc_id"]: r for r in rows_of(spark, folder, "op8_quality_rules")}
    for i, t in enumerate(TEXTS):
        n = len((t or "").split())
        assert got[i]["n_words"] == n and got[i]["base_failed"] == (n < 20 or 100 * got[i]["n_repeat_words"] > 30 * n)
        assert not (got[i]["base_failed"] and got[i]["kept"])
    assert all(got[i]["kept"] for i in range(42)) and got[len(TEXTS) - 1]["base_failed"]


def test_packing(spark, folder):
    import public_tokenizers

    model = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows, room = rows_of(spark, folder, "op9_packing"), {}
    for i, t in enumerate(TEXTS):
        ids, at = np.array([*model.encode(t or "", add_special_tokens=False).ids, 1], "<u4"), 0
        for r in sorted((r for r in rows if r["doc_id"] == i), key=lambda r: r["start"]):
            part = ids[at : at + r["length"]]
            assert (r["start"], r["doc_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(part.tobytes()))
            at += r["length"]
            room.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        assert at == len(ids)
    for pieces in room.values():
        pieces.sort()
        assert [o for o, _ in pieces] == [sum(n for _, n in pieces[:k]) for k in range(len(pieces))] and sum(n for _, n in pieces) <= 2048


def test_html(spark, folder):
    got = [(r["page_id"], r["text"], r["n_chars"]) for r in rows_of(spark, folder, "op10_html")]
    text = lambda i: f"T {i}\n\ntext & {i}"
    want = [(i, text(i), len(text(i))) for i in range(6)] + [(10, "", 0), (11, "", 0), (12, text(0), len(text(0))), (12, text(0), len(text(0)))]
    assert sorted(got) == sorted(want)


def test_pipeline(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "quality_rules", "simhash", "packing"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, folder)
        assert kept.columns == docs.columns
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        assert all(before[r["doc_id"]] == r["text"] for r in kept.collect())
        docs = spark.createDataFrame(kept.collect(), docs.schema)
    packed = corpus_pipeline.run(spark, folder).collect()
    kept = {r["doc_id"] for r in packed}
    assert kept == {r["doc_id"] for r in docs.collect()} and kept and not kept & {40, 41, 42, 43, 44, 47}
    for i in kept:
        own = sorted((r["start"], r["length"]) for r in packed if r["doc_id"] == i)
        assert [s for s, _ in own] == [sum(n for _, n in own[:k]) for k in range(len(own))]
    assert corpus_pipeline.run(spark, f"{folder}/none").count() == 0


def test_extra_columns_do_not_matter(spark, folder, tmp_path):
    d = str(tmp_path)
    for t in ("documents", "embeddings", "labels", "pages", "conversations"):
        spark.read.parquet(f"{folder}/{t}.parquet").withColumn("u", F.lit(1)).withColumn("node", F.lit("x")).withColumn("_hash", F.lit(2)).withColumn("n", F.lit(3)).write.parquet(f"{d}/{t}.parquet")
    for name in ("op1_chat", "op2_warc", "op5_simhash", "op8_quality_rules", "op10_html"):
        assert sorted(map(str, rows_of(spark, d, name))) == sorted(map(str, rows_of(spark, folder, name)))
    assert {r["doc_id"] for r in corpus_pipeline.run(spark, d).collect()} == {r["doc_id"] for r in corpus_pipeline.run(spark, folder).collect()}


def test_token_counts(spark, folder):
    known = encoding(default_vocabulary())
    count = lambda t: len(known.encode(t, allowed_special="all"))
    got = {r["doc_id"]: r for r in rows_of(spark, folder, "op4_token_counts")}
    for i, t in enumerate(TEXTS):
        t = t or ""
        n, new = len(t), t
        for start, end, said in ((n // 3, n // 3 + 20, t[:40]), (n // 2, n // 2, "\n" + t[-30:] if t else "\n"), (0, 10, "")):
            start, end = min(start, len(new)), min(end, len(new))
            new = new[:start] + said + new[end:]
        r = got[i]
        assert (r["n_chars"], r["n_tokens"], r["edited_chars"], r["edited_tokens"]) == (n, count(t), len(new), count(new)), i


def test_trees_in_buckets_stay_where_they_are(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = token_counts.keep_trees(token_counts.trees(docs), "kept_trees", buckets=4)
    edits = spark.createDataFrame([(1, 2, 0, 3, "new words "), (1, 1, 5, 9, None), (3, 1, 0, 0, "x"), (999, 1, 0, 1, "none")], "doc_id long, seq int, start long, end long, new string")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = token_counts.apply_edits(kept, edits)
        plan = out._jdf.queryExecution().executedPlan().toString()
        shuffled = [line for line in plan.splitlines() if "Exchange hashpartitioning(doc_id" in line]
        got = {r["doc_id"]: r for r in out.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert len(shuffled) == 2 and "Bucketed: true" in plan  # the edits, once for each of the two branches
    known = encoding(default_vocabulary())
    want = "new words " + (TEXTS[1][:5] + TEXTS[1][9:])[3:]
    assert len(got) == len(TEXTS) and "".join(x["text"] for x in got[1]["leaves"]) == want
    assert got[1]["edited_tokens"] == len(known.encode_ordinary(want)) and got[2]["reencoded_chars"] == 0 and got[2]["n_tokens"] == got[2]["edited_tokens"] == len(known.encode_ordinary(TEXTS[2]))


def test_pieces(spark, folder):
    s = pieces.segmenter(pieces.default_model())
    got = {r["doc_id"]: r for r in rows_of(spark, folder, "op6_pieces")}
    for i, t in enumerate(TEXTS):
        ids, n, scores = s.encode(t)
        assert (got[i]["n_pieces"], got[i]["ids_crc32"], got[i]["scores"]) == (n, zlib.crc32(ids), pytest.approx(scores)) and len(scores) >= 1
        assert got[i]["decoded_sha256"] == hashlib.sha256((t or "").encode()).hexdigest()
