"""Operators of the optional subpackage against brute force and round trips, with their edge cases."""

import hashlib
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cairnspark.functions import joins
from cairnspark.llm import chat, digest, html, nearcopies, packing, pieces, quality, simhash, token_counts, toxicity, warc
from cairnspark.llm.tokens import default_vocabulary, encoding, token_ids

DOCS = "doc_id long, text string, lang string, source string, key string, at long, fp long"


def docs(spark, texts, ids=None):
    rows = [(i, t, "en", None, "clash", 1, 2) for i, t in zip(ids or range(len(texts)), texts, strict=True)]
    return spark.createDataFrame(rows, DOCS)


EDGE = [None, "", "   \n", "one two", "one two", "wörd " * 30_000, "a b c d e f g h " * 3, "Tie. " * 40, "Ünï 漢字 \U0001f600 ok"]
IDS = [0, 1, 2, 3, 3, 5, 6, 7, None]


# 1 chat
def test_chat_round_trip_and_fold(spark):
    nasty = ["\\### Assistant: </turn> ok", "### x: </turn>\n\\", "", None, "a\\/b \\\\ <\\/turn>", "</turn></turn>"]
    rows = [(1, i, i, "message", ["user", "assistant", "a:b%"][i % 3], t) for i, t in enumerate(nasty)]
    events = spark.createDataFrame(rows, "conv_id long, seq long, message_id long, op string, role string, text string")
    r = chat.render(chat.fold(events)).select(chat.parse(F.col("formatted")).alias("t"), chat.learned_text(F.col("formatted"), F.col("loss_spans")).alias("l")).first()
    assert [(x["role"], x["text"]) for x in r["t"]] == [(["user", "assistant", "a:b%"][i % 3], t or "") for i, t in enumerate(nasty)]
    assert r["l"] == nasty[1] + nasty[4]
    log = [(2, 1, 9, "delta", "assistant", "Hel"), (2, 2, 9, "delta", None, "lo"), (2, 3, 9, "regenerate", None, None), (2, 4, 9, "delta", None, "Bye"),
           (2, 5, 9, "edit", None, "Good"), (2, 6, 9, "delta", None, " day"), (2, 0, 8, "message", "user", "hi"), (2, 7, 7, "message", "user", "x"), (2, 8, 7, "delete", None, None)]
    turns = chat.fold(spark.createDataFrame(log, events.schema)).orderBy("seq").collect()
    assert [(t["role"], t["text"]) for t in turns] == [("user", "hi"), ("assistant", "Good day")]
    assert chat.render(chat.fold(events.limit(0))).count() == 0
    doubled = chat.render(chat.fold(events.unionByName(events))).select(F.size(chat.parse(F.col("formatted"))).alias("n")).first()
    assert doubled["n"] == 2 * len(nasty)


# 2 WARC
def test_warc(spark, tmp_path):
    rows = [(1, "http://a\r\nX: y", "same"), (4, "http://b", "same"), (3, None, None), (2, "http://c", ""), (5, "http://d", "é\r\n\r\nx"), (5, "http://d", "é\r\n\r\nx")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("clash"))
    folder = warc.write_archive(pages, str(tmp_path / "w"))
    got = {r["key"]: r for r in warc.read_archive(spark, folder).withColumn("t", warc.field("WARC-Type")).withColumn("r", warc.field("WARC-Refers-To")).collect()}
    assert {k: (r["t"], r["r"]) for k, r in got.items()} == {
        1: ("revisit", "<urn:x-page:4>"), 4: ("response", None), 3: ("response", None), 2: ("revisit", "<urn:x-page:3>"), 5: ("response", None)}
    assert bytes(got[5]["record"]).endswith("é\r\n\r\nx\r\n\r\n".encode())
    assert spark.read.parquet(f"{folder}/payloads").count() == 3
    warc.export_text(spark, folder, str(tmp_path / "text"), "none")
    whole = b"".join(p.read_bytes() for p in (tmp_path / "text").glob("part-*"))
    assert whole.count(b"WARC/1.1\r\n") == 6 and whole.endswith(b"\r\n\r\n")
    empty = warc.write_archive(pages.limit(0), str(tmp_path / "e"))
    assert warc.read_archive(spark, empty).count() == 0


def test_warc_detects_damage(spark, tmp_path):
    folder = warc.write_archive(spark.createDataFrame([(1, "u", "x")], "page_id long, url string, html string"), str(tmp_path / "w"))
    bad = spark.read.parquet(f"{folder}/payloads").withColumn("payload", F.encode(F.lit("y"), "utf-8")).toPandas()
    spark.createDataFrame(bad).write.mode("overwrite").parquet(f"{folder}/payloads")
    with pytest.raises(Exception, match="differ"):
        warc.read_archive(spark, folder).collect()


# 3 toxicity
def test_kernel_is_the_sum_over_subsequences():
    from itertools import combinations

    def brute(s, t):
        def feature(x):
            out = {}
            for c in combinations(range(len(x)), 3):
                u = tuple(x[i] for i in c)
                out[u] = out.get(u, 0) + toxicity.LAMBDA ** (c[2] - c[0] + 1)
            return out
        a, b = feature(s), feature(t)
        return sum(v * b.get(k, 0) for k, v in a.items())

    rng = random.Random(1)
    for _ in range(30):
        s, t = ([rng.randint(1, 4) for _ in range(rng.randint(1, 9))] for _ in range(2))
        assert toxicity.kernel(np.array([s]), np.array([t]))[0] == pytest.approx(brute(s, t), rel=1e-4, abs=1e-6)


def test_toxicity_sample_keeps_a_unit_once(spark):
    labels = spark.createDataFrame([(0, 1), (1, 0)], "doc_id long, toxic int")
    sample = toxicity.training_sample(docs(spark, ["alpha common words", "common words beta"]), labels, "doc_id", "text", "toxic", 10, 100)
    assert len(sample) == 2
    (_, a), (_, b) = sample
    assert a & b and {id(x) for x in a if x in b} == {id(x) for x in b if x in a}


def test_toxicity_finds_disguised_insults(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice(["the", "an", "re", "ti", "on", "ou", "wh"]) for _ in range(rng.randint(1, 3)))
    bags = []
    for i in range(300):
        text = " ".join(word() for _ in range(30)) + " You"
        bags.append((i % 3 == 0, toxicity.units(text + (" " + rng.choice(["blockhead!", "scoundrel."]) if i % 3 == 0 else ""))))
    model = toxicity.fit(bags)
    score = lambda t: float(model.probability(toxicity.Scorer(model).features([t]))[0])
    assert all(score(f"an ontithe {x} re") >= 0.3 for x in ("blockhead", "Block-head", "b l o c k h e a d", "blockxhead", "SCOUNDREL"))
    assert max(score(" ".join(word() for _ in range(50))) for _ in range(50)) < 0.3 and score(None) == score("") == score(" ") < 0.3
    scored = docs(spark, EDGE, IDS).select("doc_id", toxicity.score(model, F.col("text")).alias("s")).collect()
    assert len(scored) == len(EDGE) and all(0 <= r["s"] <= 1 for r in scored)
    assert toxicity.fit([(False, {b"a"})]) is None
    labels = spark.createDataFrame([(0, None), (1, 0)], "doc_id long, toxic int")
    assert toxicity.drop_toxic(docs(spark, EDGE, IDS), labels).count() == len(EDGE)


# 4 token counts
def test_one_doubtful_unit_of_a_long_text_is_not_enough():
    rng = np.random.default_rng(1)
    clean = [(m, m - 1.5, np.log1p(200), 1.0) for m in rng.uniform(-1.5, 0.5, 300)]
    bad = [(m, m - 0.1, np.log1p(200), 1.0) for m in rng.uniform(0.2, 1.5, 60)]
    w = toxicity._platt(np.array(clean + bad), np.array([-1.0] * 300 + [1.0] * 60))
    model = toxicity.Model(np.zeros(1), 0.0, w)
    alone, pair = model.probability(np.array([(0.4, -1.1, np.log1p(200), 1.0), (0.4, 0.3, np.log1p(200), 1.0)]))
    assert alone < 0.3 < pair and w[0] > 0 and w[1] >= 0
    assert toxicity._features(set(), {}) == (-1.0, -1.0, 0.0, 1.0)


def test_token_tree_equals_encoding_again(spark):
    path, rng = default_vocabulary(), random.Random(3)
    count = lambda t: len(token_ids(t, path))
    for k in range(120):
        signs = list("ab \n'1.  ") if k % 2 else ["a", "漢", "字", "。", "'s", "|", "<|endoftext|>", "<|end", "oftext|>", " ", "é", "²", "_"]
        text = "".join(rng.choices(signs, k=rng.randint(0, 300)))
        tree = token_counts.TokenTree(text, path, size=8)
        for _ in range(6):
            i, j = rng.randint(0, len(text) + 2), rng.randint(0, len(text) + 2)
            new = "".join(rng.choices(signs, k=rng.choice([0, 1, 3, 40, 200])))
            tree.edit(i, j, new)
            i = min(i, len(text))
            text = text[:i] + new + text[max(i, min(j, len(text))):]
            assert (tree.text(), tree.n_tokens, tree.n_chars) == (text, count(text), len(text))
    long = "some words here " * 5000
    tree = token_counts.TokenTree(long, path)
    before = tree.encoded_chars
    tree.edit(40_000, 40_010, "other")
    assert tree.encoded_chars - before < 1000
    chinese = token_counts.TokenTree("漢字很多。" * 5000, path)
    before = chinese.encoded_chars
    chinese.edit(12_000, 12_010, "другое")
    assert chinese.encoded_chars - before < 1000
    rows = token_counts.count_with_edits(docs(spark, EDGE, IDS)).collect()
    assert sorted(r["n_tokens"] for r in rows) == sorted(count(t or "") for t in EDGE)
    assert token_counts.count_with_edits(docs(spark, []).limit(0)).count() == 0


def test_edits_of_kept_trees(spark):
    path = default_vocabulary()
    texts = ["some words here " * 300, "short", "", None, "漢字很多。" * 300]
    kept = token_counts.trees(docs(spark, texts))
    edits = [(0, 2, 5, 9, "x y"), (0, 1, 0, 4, ""), (2, 1, 0, 0, "new text"), (4, 1, 700, 710, None), (9, 1, 0, 1, "lost"), (1, 1, -5, 500, "all")]
    table = spark.createDataFrame(edits, "doc_id long, seq long, start long, end long, new string")
    got = {r["doc_id"]: r for r in token_counts.apply_edits(kept, table).collect()}
    after = list(t or "" for t in texts)
    for i, _, a, b, new in sorted(edits):
        if i < 5:
            a = max(a, 0)
            after[i] = after[i][:a] + (new or "") + after[i][b:]
    for i, t in enumerate(texts):
        assert got[i]["n_tokens"] == len(token_ids(t, path)) and got[i]["edited_tokens"] == len(token_ids(after[i], path))
        assert "".join(x["text"] for x in got[i]["leaves"]) == after[i] and sum(x["tokens"] for x in got[i]["leaves"]) == got[i]["edited_tokens"]
    assert got[3]["reencoded_chars"] == 0 and got[0]["reencoded_chars"] < 1500


def test_rank_file_and_tokenizer_agree():
    import public_tokenizers

    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    whole.encode_special_tokens = True
    rng = random.Random(5)
    for _ in range(2000):
        t = "".join(rng.choices(list("ab1 '\n\t!é漢   ́s’\x1c\x85"), k=rng.randint(0, 14)))
        assert token_ids(t, default_vocabulary()).tolist() == whole.encode(t, add_special_tokens=False).ids


def test_added_tokens_as_in_tokenizers():
    import public_tokenizers

    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rng = random.Random(17)
    parts = ["<|endoftext|>", "<|endoftext", "|>", " ", "\n", "a", "b ", "é", "漢", "'s", "<|ENDOFTEXT|>"]
    texts = ["a <|endoftext|> b", *["".join(rng.choices(parts, k=rng.randint(0, 12))) for _ in range(2000)]]
    for t in texts:
        assert token_ids(t, default_vocabulary()).tolist() == whole.encode(t, add_special_tokens=False).ids, repr(t)
    assert token_ids(texts[0], default_vocabulary()).tolist() == [64, 220, 50256, 275]


# 5 SimHash
def components(prints):
    parent = list(range(len(prints)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= 3:
                parent[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(prints))]


@pytest.mark.parametrize("hot", [64, 3])
def test_links_give_the_components_of_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(simhash, "HOT_BUCKET", hot)
    rng = random.Random(7)
    centres = [rng.getrandbits(64) for _ in range(6)]
    prints = sorted({c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))) for c in centres for _ in range(25)})
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    classes = spark.createDataFrame([(p,) for p in signed], "fp long")
    nodes = spark.createDataFrame(list(zip(signed, range(len(signed)), strict=True)), "node long, label long")
    labels = {r["node"]: r["label"] for r in simhash.connected_components(simhash.links(classes), nodes).collect()}
    assert [labels.get(p, i) for i, p in enumerate(signed)] == components(prints)


@pytest.mark.parametrize("hot", [64, 2])
def test_exploded_probes_are_not_broadcast(spark, monkeypatch, hot):
    monkeypatch.setattr(simhash, "HOT_BUCKET", hot)
    prints = spark.range(400).select((F.xxhash64("id").bitwiseAND(F.lit(-16)) if hot == 64 else F.col("id")).alias("fp"))
    plan = simhash.links(simhash.cut(prints))._jdf.queryExecution().executedPlan().toString().split("\n")
    depth = lambda line: len(line) - len(line.lstrip(" :+-*()0123456789"))
    for at, line in enumerate(plan):
        if "BroadcastExchange" in line:
            below = plan[at + 1 :]
            end = next((i for i, x in enumerate(below) if depth(x) <= depth(line)), len(below))
            assert not any("explode" in x and "posexplode" not in x for x in below[:end])


def test_simhash_edges(spark):
    rows = simhash.near_duplicates(docs(spark, EDGE, IDS)).collect()
    assert len(rows) == len(EDGE)
    assert {r["component_id"] for r in rows if r["doc_id"] in (0, 1, 2)} == {0}
    assert next(r["fingerprint"] for r in rows if r["doc_id"] == 0) == "0" * 16
    assert simhash.keep_one(docs(spark, EDGE, IDS)).filter("doc_id = 3").count() == 2  # repeated rows stay together
    assert simhash.near_duplicates(docs(spark, EDGE, IDS).limit(0)).count() == 0


def test_near_copies_are_sought_by_fingerprints(spark):
    """Without any band, texts whose fingerprints lie within three bits are still found and verified."""
    base = " ".join(f"w{i}" for i in range(2000))
    texts = [base, "another " + base, "n0 " + base, " ".join(f"v{i}" for i in range(2000))]
    nodes = spark.createDataFrame(
        [(nearcopies.node_of(w), len(nearcopies.shingles(w)), [], b"", simhash.signed(simhash.fingerprint_of(w)), (False, i, 0)) for i, w in enumerate(map(nearcopies.words_of, texts))],
        "node long, size long, bands array<long>, sketch binary, fp long, first struct<none: boolean, key: long, mark: long>")
    rows = docs(spark, texts)
    marked = rows.select("doc_id", nearcopies.text_mark(F.col("text")).alias("m"))
    nodes = nodes.join(marked, F.col("doc_id") == F.col("first.key")).withColumn("first", F.struct(F.lit(False).alias("none"), F.col("doc_id").alias("key"), F.col("m").alias("mark"))).drop("doc_id", "m")
    at = {nearcopies.node_of(nearcopies.words_of(t)): i for i, t in enumerate(texts)}
    found = {frozenset((at[r["u"]], at[r["v"]])) for r in nearcopies.links(nodes, rows, "text").collect()}
    prints = [simhash.fingerprint(t) for t in texts]
    want = {frozenset((i, j)) for i in range(4) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 3}
    assert prints[0] == prints[1] != prints[2]  # a shared fingerprint and one apart
    assert found <= want and set().union(*found) == {0, 1, 2} and len(found) >= 2


@pytest.mark.parametrize("share", [1, 10**9])
def test_heavy_fingerprints_get_the_same_class(spark, monkeypatch, share):
    rows = docs(spark, ["a b c d e"] * 30 + ["f g h i j", "k l m n o"] + [None] * 3, list(range(35)))
    want = {tuple(r) for r in simhash.near_duplicates(rows).collect()}
    monkeypatch.setattr(joins, "HEAVY", share)  # none is heavy, or all are
    assert {tuple(r) for r in simhash.near_duplicates(rows).collect()} == want and len(want) == 35


@pytest.mark.parametrize("hot", [64, 3])
def test_keep_one_joins_near_copies_only(spark, monkeypatch, hot):
    monkeypatch.setattr(nearcopies, "HOT_BUCKET", hot)
    rng = random.Random(15)
    texts = []
    for _ in range(12):
        base = [f"w{rng.randint(0, 10**6)}" for _ in range(120)]
        for _ in range(6):
            copy = list(base)
            for at in rng.sample(range(120), rng.randint(0, 6)):
                copy[at] = f"x{rng.randint(0, 10**6)}"
            texts.append(" ".join(copy))
    texts += [None, "", "one two", "One  two"]
    sets = [set(nearcopies.shingles(nearcopies.words_of(t)).tolist()) for t in texts]
    parent = list(range(len(texts)))
    near = lambda a, b: a == b or len(a & b) >= 0.8 * len(a | b)
    for _ in texts:
        for i in range(len(texts)):
            parent[i] = min(parent[j] for j in range(len(texts)) if near(sets[i], sets[j]))
    got = {r["doc_id"]: r["component_id"] for r in nearcopies.near_copies(docs(spark, texts)).collect()}
    assert [got[i] for i in range(len(texts))] == parent and 12 < len(set(parent)) < 60
    assert {r["doc_id"] for r in simhash.keep_one(docs(spark, texts)).collect()} == set(parent)


@pytest.mark.parametrize("few", [-1, 1000])
def test_torn_buckets_by_sketches_and_by_sets(spark, monkeypatch, few):
    for name, value in (("HOT_BUCKET", 2), ("SKETCH_NODES", 30), ("BLOCK_NODES", 25), ("FEW", few), ("MARK_BYTES", max(0, few))):  # dense always, never
        monkeypatch.setattr(nearcopies, name, value)
    rng = random.Random(4)
    shared = [f"s{i}" for i in range(60)]
    texts = [" ".join(shared + [f"w{rng.randint(0, 10**6)}" for _ in range(rng.choice((4, 40)))]) for _ in range(60)]
    texts += [t + f" y{i}" for i, t in enumerate(texts[:20])]
    sets = [set(nearcopies.shingles(nearcopies.words_of(t)).tolist()) for t in texts]
    parent = list(range(len(texts)))
    for _ in texts:
        parent = [min(parent[j] for j in range(len(texts)) if len(a & sets[j]) >= 0.8 * len(a | sets[j])) for a in sets]
    got = {r["doc_id"]: r["component_id"] for r in nearcopies.near_copies(docs(spark, texts)).collect()}
    assert [got[i] for i in range(len(texts))] == parent and 2 < len(set(parent)) < 60


def test_a_text_does_not_go_with_another_of_its_key(spark):
    copied, own = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(40))
    rows = [(1, copied), (5, copied), (5, own), (None, own), (None, "c d e"), (7, "c d e")]
    kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((str(r["doc_id"]), r["text"]) for r in kept) == [("1", copied), ("5", own), ("7", "c d e")]


# 6 pieces
def test_n_best_equals_brute_force_and_decodes(spark):
    s = pieces.segmenter(pieces.default_model())

    def brute(text):
        m = pieces.SPACE + text.replace(" ", pieces.SPACE)
        best = [[0.0]] + [[] for _ in m]
        for j in range(1, len(m) + 1):
            found = [a + s.pieces[m[i:j]][1] for i in range(j) if m[i:j] in s.pieces for a in best[i]]
            if m[j - 1] not in s.pieces:
                found += [a + s.lowest * len(m[j - 1].encode()) for a in best[j - 1]]
            best[j] = sorted(found, reverse=True)[: s.n_best]
        return best[-1]

    rng = random.Random(9)
    for _ in range(300):
        t = "".join(rng.choices("thea  ing.,é漢\n", k=rng.randint(1, 14)))
        assert np.allclose(s.encode(t)[2], brute(t))
    for t in ["▁x ▁ y", "  a ", "漢\U0001f600", "\x00", *[x or "" for x in EDGE]]:
        assert s.decode(s.encode(t)[0]) == t
    for path in (None, "▁"):  # one at a time and many together give the same
        some = ["".join(rng.choices("thea  ing.,é漢\x00\U0001f600\n" + (path or ""), k=rng.randint(0, 90))) for _ in range(400)]
        alone = pieces.Segmenter(pieces.default_model())
        assert pieces.Segmenter(pieces.default_model()).encode_all(some) == [alone.encode(t) for t in some]
    assert pieces.encode_texts(docs(spark, EDGE, IDS)).count() == len(EDGE)


def test_pieces_beside_the_library():
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())
    s, rng, same = pieces.segmenter(pieces.default_model()), random.Random(25), 0
    for _ in range(400):
        word = "".join(rng.choices("etaoinshr", k=rng.randint(1, 7)))
        ids, _, scores = s.encode(word)
        ours, theirs = np.frombuffer(ids, "<u4").tolist(), model.encode(word)
        assert model.decode(ours) == word
        score = sum(map(model.get_score, theirs))
        assert score <= scores[0] + 1e-6 and (score < scores[0] - 1e-6 or len(set(np.round(scores[:2], 6))) < 2 or ours == theirs)
        same += ours == theirs
    assert 0 < same < 400


# 7 digests
def test_digests(spark):
    texts = [(i, t) for i, t in zip([9, 7, 5, 3, 1], ["abcdef ghij " * 20, "", None, "xyz", "漢字" * 50], strict=True)]
    got = digest.compare_with_edits(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    assert len(got) == 5
    for r in got:
        at = [i for i, _ in texts].index(r["doc_id"])
        t, n = texts[at][1] or "", texts[(at + 1) % 5][1] or ""
        half = len(t) // 2
        edited = t[: len(t) - half] + n[:half]
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest() and r["fingerprint"] == digest.digest(t)
        assert r["near_edited"] == digest.likeness(digest.digest(t), digest.digest(edited)) and 0 <= r["near_next"] <= 1
    assert len(digest.compare_with_edits(docs(spark, EDGE, IDS)).collect()) == len(EDGE)
    assert digest.compare_with_edits(docs(spark, EDGE, IDS).limit(0)).count() == 0


def test_next_across_ranges(spark, monkeypatch):
    monkeypatch.setattr(digest, "RANGE_BYTES", 300)
    d = spark.range(97).select((F.col("id") * 3).alias("doc_id"), F.col("id").cast("string").alias("text"))
    assert {int(r["text"]): int(r["next_text"]) for r in digest.with_next(d).collect()} == {i: (i - 1) % 97 for i in range(97)}


def test_next_of_a_key_that_repeats(spark, monkeypatch):
    monkeypatch.setattr(digest, "RANGE_BYTES", 300)
    rows = [(5, f"text {i}") for i in range(60)] + [(9, "last"), (1, "first"), (5, "text 7"), (None, "none")]
    got = digest.with_next(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == 64 and sorted(r["text"] for r in got) == sorted(r["next_text"] for r in got) == sorted(t for _, t in rows)
    by_text = {}
    for r in got:
        by_text.setdefault(r["text"], []).append(r["next_text"])
    seen, at = [], "last"
    while len(seen) < 63:
        seen.append(at)
        step = [t for t in by_text[at] if t != at]
        at = step[0]
    assert seen[-2:] == ["first", "none"] and at == "last" and by_text["text 7"].count("text 7") == 1


def test_digest_counts_triplets():
    rng = random.Random(29)
    for _ in range(30):
        raw = bytes(rng.randint(0, 255) for _ in range(rng.randint(0, 60)))
        padded, counts = raw.ljust(4, b"\0"), [0] * 256
        mix = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F, 0x165667B1)
        for i in range(len(padded) - 3):
            a, b, c, d = padded[i : i + 4]
            for h in (a * mix[0] + b * mix[1] + c * mix[2], a * mix[0] + b * mix[1] + d * mix[3], a * mix[0] + c * mix[2] + d * mix[4]):
                counts[(h * 0x2C1B3C6D & 0xFFFFFFFF) >> 24] += 1
        assert digest._buckets(raw).tolist() == counts
        text = raw.decode("latin-1")
        made = bytes.fromhex(digest.digest(text))
        counts = digest._buckets(text.encode()).tolist()
        q1, q2, q3 = (sorted(counts)[k] for k in (63, 127, 191))
        codes = [(n > q1) + (n > q2) + (n > q3) for n in counts]
        assert [made[3 + i // 4] >> (2 * (i % 4)) & 3 for i in range(256)] == codes
        other = digest.digest(text[::-1] + "x")
        theirs = [bytes.fromhex(other)[3 + i // 4] >> (2 * (i % 4)) & 3 for i in range(256)]
        apart = sum((0, 1, 2, 6)[abs(x - y)] for x, y in zip(codes, theirs, strict=True))
        apart += min(12, abs(made[0] - bytes.fromhex(other)[0]) / 8) + sum(abs(made[k] - bytes.fromhex(other)[k]) for k in (1, 2)) / 32
        assert digest.likeness(made.hex(), other) == pytest.approx(max(0, 1 - apart / 416)) or made.hex() == other


# 8 quality
def test_counts_equal_brute_force(spark):
    rng = random.Random(11)
    texts = [*EDGE, *["".join(rng.choices(["a ", "b ", "c\n", "# ", "\t", "d|e "], k=rng.randint(0, 80))) for _ in range(60)]]
    got = docs(spark, texts).select("doc_id", quality.counts(F.col("text")).alias("c")).select("doc_id", "c.*").toPandas().set_index("doc_id")
    for i, t in enumerate(texts):
        t = t or ""
        words = [w for w in t.replace("\t", " ").replace("\n", " ").split(" ") if w]
        seen, dup = set(), 0
        for line in t.split("\n"):
            if line.strip(" \t"):
                dup += line in seen
                seen.add(line)
        windows = [tuple(words[k : k + 8]) for k in range(len(words) - 7)]
        many = {w for w, n in pd.Series(windows, dtype=object).value_counts().items() if n > 1} if windows else set()
        covered = {k + j for k, w in enumerate(windows) if w in many for j in range(8)}
        marks = [w for w in words if not any(c.isalnum() for c in w)]
        want = (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in t), dup, len(covered), len(set(words)), len(marks))
        assert tuple(got.loc[i, ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_distinct", "n_wordless"]]) == want, repr(t[:80])


def plain_em(rows):
    """Expectation-maximisation document by document, with the rates themselves in place of their log-odds."""
    score = lambda v: 1.0 + sum({-1: -2.0, 0: 0.0, 1: 0.25}[x] for x in v)
    good = [1 / (1 + np.exp(-score(v))) for v in rows]
    for _ in range(400):
        rate = []
        for side in (good, [1 - g for g in good]):
            rate.append([{x: (sum(p for v, p in zip(rows, side, strict=True) if v[j] == x) + 1) / (sum(side) + 3) for x in (-1, 0, 1)} for j in range(len(rows[0]))])
        prior = (sum(good) + 1) / (len(rows) + 2)
        after = []
        for v in rows:
            a = prior * np.prod([rate[0][j][x] for j, x in enumerate(v)])
            b = (1 - prior) * np.prod([rate[1][j][x] for j, x in enumerate(v)])
            after.append(a / (a + b))
        good = after
    return good


def drawn_votes(n=800, seed=21):
    """Votes of good documents, of which a tenth fires rule 0 alone, and of bad ones, which fire rules 1 to 3 or abstain there."""
    rng, rows = random.Random(seed), []
    for i in range(n):
        v = [1] * len(quality.RULES)
        if i % 8:
            v[0] = -1 if rng.random() < 0.1 else 1
        else:
            for j in (1, 2, 3, 4):
                v[j] = rng.choices([-1, 0, 1], [6, 3, 1])[0]
        rows.append(tuple(v))
    return rows


def test_em_equals_plain_em():
    rows = drawn_votes(240)
    counts = {v: rows.count(v) for v in set(rows)}
    model = quality.fit(list(counts.items()), rounds=2000, rest=0)
    assert np.allclose([quality.posterior(v, model) for v in rows], plain_em(rows), atol=1e-6)


def test_em_weighs_votes_by_what_the_data_say():
    rows = drawn_votes()
    model = quality.fit([(v, rows.count(v)) for v in set(rows)])
    clean = (1,) * len(quality.RULES)
    put = lambda v, **at: tuple(at.get(f"r{j}", x) for j, x in enumerate(v))
    assert quality.posterior(clean, model) > 0.99
    assert quality.posterior(put(clean, r0=-1), model) > 0.9  # one rule fails, and the document stays
    assert quality.posterior(put(clean, r1=0, r2=0, r3=0, r4=0), model) < 0.5  # no rule fails, and it goes
    assert quality.posterior(put(clean, r1=-1, r2=-1), model) < 0.5  # evidence adds up
    assert quality.posterior((0,) * len(quality.RULES), quality.fit([])) > 0.5


def test_documents_that_fail_one_rule_stay(spark):
    rng = random.Random(23)
    word = lambda: "".join(rng.choice(["ta", "ri", "mo", "len", "ku", "so"]) for _ in range(2))
    line = lambda n: " ".join(word() for _ in range(n)).capitalize() + "."
    text = lambda: "\n".join(line(12) for _ in range(8))
    numbers = lambda: " ".join(str(rng.randint(10**5, 10**6)) if i % 4 == 0 else word() + "." * (i % 12 == 3) for i in range(96))
    marks = lambda: " ".join(word() + rng.choice(["###", "&&&", "%%%"]) for _ in range(90)) + "."
    made = [text() for _ in range(300)] + [numbers() for _ in range(30)] + [marks() for _ in range(30)]
    rows = {r["doc_id"]: r for r in quality.judge(docs(spark, made)).collect()}
    assert all(rows[i]["kept"] for i in range(300)) and not any(rows[i]["kept"] for i in range(330, 360))
    assert all(rows[i]["votes"]["digits"] == -1 and rows[i]["kept"] for i in range(300, 330))
    assert {r["doc_id"] for r in quality.keep_good(docs(spark, made)).collect()} == {i for i, r in rows.items() if r["kept"]}


def test_columns_of_the_input_are_left_alone(spark):
    text = " ".join(f"word{i}" for i in range(60)) + "."
    rows = spark.createDataFrame([(1, text, "a", "b")], "doc_id long, text string, judged string, _counts string")
    kept = quality.keep_good(rows)
    assert kept.columns == rows.columns and [tuple(r) for r in kept.collect()] == [(1, text, "a", "b")]


def test_judge_edges(spark):
    rows = {r["doc_id"]: r for r in quality.judge(docs(spark, EDGE, IDS)).collect()}
    assert rows[0]["base_failed"] and not rows[0]["kept"] and rows[6]["base_failed"]
    assert quality.judge(docs(spark, EDGE).limit(0)).count() == 0 and quality.keep_good(docs(spark, EDGE)).columns == docs(spark, EDGE).columns


# 9 packing
def test_packing_is_whole(spark):
    texts = [*EDGE, *[f"word{i} " * (i * 37 % 3000) for i in range(80)]]
    ids = list(range(len(texts)))
    rows = packing.pack(docs(spark, texts, ids)).toPandas()
    for i, t in zip(ids, texts, strict=True):
        own = rows[rows.doc_id == i].sort_values("start")
        whole = np.concatenate([token_ids(t, default_vocabulary()), np.array([1], "<u4")])
        assert b"".join(own.ids) == whole.tobytes() and (own.doc_tokens == len(whole)).all()
        assert (own.start == own.length.cumsum() - own.length).all()
    ordered = rows.sort_values(["sequence_id", "offset"])
    assert (ordered.groupby("sequence_id").length.cumsum() - ordered.length == ordered.offset).all()
    assert rows.groupby("sequence_id").length.sum().max() <= 2048
    assert packing.pack(docs(spark, EDGE).limit(0)).count() == 0


def test_differencing():
    rng = random.Random(13)
    lengths = [rng.randint(1, 512) for _ in range(400)]
    groups = packing.difference(lengths, 40)
    sums = [sum(lengths[i] for i in g) for g in groups]
    assert sorted(i for g in groups for i in g) == list(range(400)) and max(sums) - min(sums) <= 30
    assert all(sum(lengths[i] for i in g) <= 600 for g in packing.windows(lengths, 600))
    assert packing.windows([], 10) == []


# 10 HTML
def test_html_blocks():
    page = """<html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body><nav><a>menu</a></nav><!-- x -->
    <div class="ad">buy</div><article><h1>Head &amp; line</h1><p><b>First  one<br><p>Second<aside>no</aside><form>f</form>
    <div class="comments">reader</div><ul><li>a<li>b</ul></article><footer>&copy; foot"""
    assert html.main_text(html.parse(page)) == "Head & line\n\nFirst one\n\nSecond\n\na\n\nb"
    assert html.main_text(html.parse("")) == "" and html.main_text(html.parse("just text &lt; here")) == "just text < here"
    assert html.main_text(html.parse("<p>unclosed <b>x<script>never")) == "unclosed x"


def test_raw_elements_end_where_the_markup_says():
    for raw in ("<script>x</script>", "<STYLE>p{}</Style >", "<textarea>\u0130</textarea>"):
        assert html.main_text(html.parse("\u0130" * 12 + raw + "abcdefgh")).split()[-1].endswith("abcdefgh")
    assert html.main_text(html.parse("\u0130" * 12 + "<p><script>x</ſcript></script>abcdefgh")) == "\u0130" * 12 + "\n\nabcdefgh"


def test_alignment_is_best_in_lists_of_any_length(monkeypatch):
    rng = random.Random(19)

    def tree(depth):
        return f"<{(t := rng.choice(['div', 'ul', 'b']))}>" + "".join(tree(depth - 1) for _ in range(rng.randint(0, 4) if depth else 0)) + f"</{t}>"

    def best(x, y):
        if x.label != y.label:
            return 0
        rows = [[0] * (len(y.children) + 1)]
        for c in x.children:
            rows.append([0])
            for j, d in enumerate(y.children):
                rows[-1].append(max(rows[-2][j + 1], rows[-1][j], rows[-2][j] + best(c, d)))
        return 1 + rows[-1][-1]

    for cells, memo, short in ((50_000, 1 << 20, 40), (2, 1 << 20, 2), (6, 2, 40)):
        monkeypatch.setattr(html, "CELLS", cells)
        monkeypatch.setattr(html, "MEMO", memo)
        monkeypatch.setattr(html, "SHORT", short)
        for _ in range(60):
            a, b = (html.parse("".join(tree(3) for _ in range(rng.randint(0, 6)))) for _ in range(2))
            pairs = html.align(a, b)
            place = [{id(n): i for i, n in enumerate(html.nodes_of(t))} for t in (a, b)]
            at = sorted((place[0][id(x)], place[1][id(y)]) for x, y in pairs)
            assert len(pairs) == best(a, b) and all(x.label == y.label for x, y in pairs)
            assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(at, at[1:]))
    monkeypatch.undo()
    long = ["<p><a>x</a></p>" if rng.random() < 0.5 else f"<div class=c{rng.randint(0, 9)}>y</div>" for _ in range(700)]
    page = html.parse("".join(["<h1>t</h1>", *long, "<h2>end</h2>"]))
    other = html.parse("".join(["<h3>t</h3>", *[x for x in long if rng.random() < 0.9], "<h4>u</h4>", "<h2>end</h2>"]))
    assert len(html.align(page, other)) == sum(1 for _ in html.nodes_of(other)) - 2
    deep = [html.parse("<div><i>x</i>" * 3000 + t) for t in ("<p>a", "<ul>b")]
    assert len(html.align(*deep)) == 6001


def test_template_is_what_all_pages_share(spark):
    body = "<body><p>Site name</p><p>{}</p><p>{}</p></body>"
    rows = [(i, f"http://h.example/{i}", body.format(f"text {i}", f"more {i}")) for i in range(5)]
    rows += [(10, "http://one.example/", body.format("only", "page")), (11, None, None)]
    rows += [(20 + i, "http://copy.example/", body.format("x", "y")) for i in range(4)]
    got = {r["page_id"]: r["text"] for r in html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert [got[i] for i in range(5)] == [f"text {i}\n\nmore {i}" for i in range(5)]
    assert got[10] == "Site name\n\nonly\n\npage" and got[11] == "" and got[20] == "Site name\n\nx\n\ny"
    assert html.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_odd_pages_do_not_undo_the_template(spark):
    body = "<body><div class=top>{}</div><div class=text><p>{}</p></div></body>"
    other = "<body><table><tr><td>Price list</td><td>{}</td></tr></table></body>"
    pages = [None, "", "<p>404", "  "] + [body.format("Site name", f"text {i}") for i in range(20)] + [body.format("Special day", "text s")]
    pages += [other.format(f"{i} pounds") for i in range(4)]
    rows = [(i, "http://h.example/", p) for i, p in enumerate(pages)]
    rows += [(100 + i, "http://three.example/", body.format("Own name", f"own {i}")) for i in range(3)]
    got = {r["page_id"]: r["text"] for r in html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert [got[i] for i in range(4)] == ["", "", "404", ""]
    assert [got[i + 4] for i in range(21)] == [*[f"text {i}" for i in range(20)], "Special day\n\ntext s"]
    assert [got[i + 25] for i in range(4)] == [f"{i} pounds" for i in range(4)]
    assert [got[i + 100] for i in range(3)] == [f"own {i}" for i in range(3)]


def test_template_alone_removes_menus_and_footers(spark):
    rng = random.Random(27)
    word = lambda: "".join(rng.choice(["ta", "ri", "mo", "len", "ku", "so"]) for _ in range(3))
    said = lambda n: " ".join(word() for _ in range(n))
    page = lambda paras: (
        "<body><div><ul>" + "".join(f"<li><a href='/{word()}'>{word()}</a></li>" for _ in range(rng.randint(4, 7))) + "</ul></div>"
        f"<div><h1><a href='/x'>{said(4)}</a></h1>" + "".join(f"<p>{t}</p>" for t in paras) + f"</div><div>Copyright h.example {said(5)}</div></body>")
    texts = [[said(30) for _ in range(rng.randint(1, 9))] for _ in range(12)]
    rows = [(i, f"http://h.example/{i}", page(t)) for i, t in enumerate(texts)]
    rows += [(50 + i, f"http://list.example/{i}", "<body><ul>" + "".join(f"<li><a>{said(3)}</a></li>" for _ in range(5)) + "</ul></body>") for i in range(4)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in html.extract(pages, names=False).collect()}
    for i, t in enumerate(texts):
        blocks = got[i].split("\n\n")
        assert blocks[1:] == t and len(blocks[0].split()) == 4  # menu and footer went, the linked heading stays
    assert all(len(got[50 + i].split("\n\n")) == 5 for i in range(4))  # a page that is nothing but links keeps them


def test_template_is_found_from_all_pages(spark):
    """The 20 pages with the smallest hashes have another head than the 280 others, which make it the template."""
    made = [(i, head, f"<body><p>{head}</p><p>text {i}</p></body>") for i in range(1500) for head in ("Site name", "Other name")]
    hashed = spark.createDataFrame(made, "i long, head string, html string").withColumn("h", F.pmod(F.xxhash64("html"), F.lit(1 << 20))).collect()
    few = [r for r in hashed if r["head"] == "Other name" and r["h"] * 300 < 64 << 20][:20]
    many = [r for r in hashed if r["head"] == "Site name" and r["h"] * 300 >= 64 << 20 and r["i"] not in {x["i"] for x in few}][:280]
    rows = [(k, "http://h.example/", r["html"]) for k, r in enumerate([*many, *few])]
    got = {r["page_id"]: r["text"] for r in html.extract(spark.createDataFrame(rows, "page_id long, url string, html string"), names=False).collect()}
    assert len(few) == 20 and [got[k] for k in range(280)] == [f"text {r['i']}" for r in many]
    assert [got[280 + k] for k in range(20)] == [f"Other name\n\ntext {r['i']}" for r in few]


def test_deep_and_wide_pages(spark):
    deep = lambda t: "<div>" * 5000 + f"<p>{t}</p>"
    wide = lambda i: "<body>" + "".join(f"<p class=c{(k * i) % 3}>w{k} {i}</p>" for k in range(20_000))
    rows = [(i, "http://deep.example/", deep(f"text {i}")) for i in range(4)] + [(10 + i, "http://wide.example/", wide(i + 1)) for i in range(3)]
    got = {r["page_id"]: r["text"] for r in html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert [got[i] for i in range(4)] == [f"text {i}" for i in range(4)]
    assert all(got[10 + i] == "\n\n".join(f"w{k} {i + 1}" for k in range(20_000)) for i in range(3))


@pytest.mark.parametrize("heavy", [1, 10**9])
def test_heavy_groups_give_the_same_texts(spark, monkeypatch, heavy):
    body = "<body><p>Site name</p><p>{}</p></body>"
    rows = [(i, f"http://h{i % 2}.example/{i}", body.format(f"text {i}")) for i in range(30)]
    monkeypatch.setattr(joins, "HEAVY", heavy)  # no group is heavy, or all are
    monkeypatch.setattr(joins, "BROADCAST_BYTES", -1)
    got = html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert sorted((r["page_id"], r["text"]) for r in got) == [(i, f"text {i}") for i in range(30)]


def test_nothing_of_an_article_is_lost(spark):
    """Headings and paragraphs that begin alike on all pages, and a list of linked sources, stay, whether the article is marked or not."""
    rng = random.Random(5)
    said = lambda n: " ".join(f"w{rng.randint(0, 10**6)}" for _ in range(n))
    rows, want = [], {}
    for k, (opening, closing) in enumerate((("<article>", "</article>"), ("<div class=text>", "</div>"))):
        for i in range(12):
            own = said(40)
            page = (
                f"<body><div><ul><li><a href=/a>{said(1)}</a><li><a href=/b>Home</a></ul></div><div>Buy {said(2)}</div>{opening}<h1>Review of item {i}</h1><p>In this part {own}</p>"
                f"<h2>Sources</h2><ul><li><a href=/{i}>{said(2)} {i}</a><li><a href=/s>Second source</a></ul>{closing}<div>Copyright h.example page {i}</div></body>")
            rows.append((100 * k + i, f"http://h{k}.example/{i}", page))
            links = page.split("<h2>")[1].split("<a href=")[1].split(">")[1].split("<")[0]
            want[100 * k + i] = f"Review of item {i}\n\nIn this part {own}\n\nSources\n\n{links}\n\nSecond source"
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    for names in (True, False):
        assert {r["page_id"]: r["text"] for r in html.extract(pages, names=names).collect()} == want
