"""Hard negatives, byte-level BPE and cross-tokenizer alignment against brute force."""

import hashlib
import random
import sys
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tiktoken
from tokenizers import Tokenizer

from cairnspark.llm import align, bpe, hardneg

PIECES = ["a", "b", "ab", "the ", " ", "  ", "\n", "é", "漢", "字", "ア", "🙂", "́", "\x1c", "\x85", "　", "1", "'s", "'ll", "!", "==", "ж", "՘", "Ⅷ", "<|endoftext|>", "<s>", "▁", "\t"]


def drawn(n, seed=3):
    r = random.Random(seed)
    return ["".join(r.choices(PIECES, k=r.randint(0, 40))) for _ in range(n)]


LONG = " ".join(f"word{i % 997}é" for i in range(20_000))
TEXTS = [*drawn(120), "plain words only, twice.", "plain words only, twice.", None, "", " ", LONG, "x" * 5000, "漢字" * 3000]


def docs(spark, texts):
    return spark.createDataFrame([(i, t, 1, "clash") for i, t in enumerate(texts)], "doc_id long, text string, ids int, key string")


# --- byte-level BPE


@pytest.fixture(scope="module")
def library():
    known = bpe.codec(bpe.default_vocabulary())
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=known.ranks, special_tokens={})


def packed(ids):
    return np.array(ids, "<u4").tobytes()


def test_bpe_equals_the_library(spark, library):
    got = {r["doc_id"]: r for r in bpe.decode(bpe.encode(docs(spark, TEXTS))).collect()}
    assert len(got) == len(TEXTS)
    for i, t in enumerate(TEXTS):
        assert bytes(got[i]["ids"]) == packed(library.encode_ordinary(t or "")) and bytes(got[i]["data"]) == (t or "").encode()


def test_bpe_query(spark, library, tmp_path):
    docs(spark, TEXTS).unionByName(docs(spark, ["again"])).write.parquet(f"{tmp_path}/documents.parquet")
    want = []
    for i, t in [*enumerate(TEXTS), (0, "again")]:
        ids = packed(library.encode_ordinary(t or ""))
        want.append((i, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted(map(tuple, bpe.op12_bpe(spark, str(tmp_path)).collect())) == sorted(want)


def test_bpe_splits_every_character_as_the_library(library):
    every = "".join(chr(i) for i in range(sys.maxunicode + 1) if not 0xD800 <= i < 0xE000)
    known = bpe.codec(bpe.default_vocabulary())
    for text in (every, "".join(f"a{c}1 {c}" for c in every[:0x3000])):
        assert known.encode(text) == packed(library.encode_ordinary(text))


@pytest.mark.parametrize("text", ["a" * 100_000, "漢字" * 20_000, "=-" * 50_000, "\n" * 30_000, "".join(random.Random(1).choices("abcdefgh", k=100_000))])
def test_bpe_of_very_long_pre_tokens(library, text):
    assert bpe.codec(bpe.default_vocabulary()).encode(text) == packed(library.encode_ordinary(text))


def test_bpe_takes_the_leftmost_and_new_lower_ranks_first(library):
    known, r = bpe.codec(bpe.default_vocabulary()), random.Random(9)
    for _ in range(3000):
        piece = bytes(r.choices(b"aenrst", k=r.randint(1, 40)))
        assert known.merged(piece) == library.encode_ordinary(piece.decode())
    assert not any(known.words) and not any(known.buckets)


# --- alignment


def plain_alignment(texts):
    a_of = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a_of.encode_special_tokens = True
    b_of = sentencepiece.SentencePieceProcessor(model_file=align.default_pieces())
    pair = align.pair_of(align.default_vocabulary(), align.default_pieces())
    sides, linked = [], []
    for t in texts:
        a = a_of.encode(f" {t}", add_special_tokens=False).ids if t else []
        b = b_of.encode(t) if t else []
        data = f" {t}".encode()
        if b"".join(pair.bytes_a[i] for i in a) != data or b"".join(pair.bytes_b[i] for i in b) != data:
            a = b = []
        owner_a = [k for k, i in enumerate(a) for _ in pair.bytes_a[i]]
        owner_b = [k for k, i in enumerate(b) for _ in pair.bytes_b[i]]
        ends = {k for k in range(1, len(owner_a) + 1) if all(k == len(o) or o[k] != o[k - 1] for o in (owner_a, owner_b))}
        groups, at = [], 0
        for end in sorted(ends):
            part = lambda o, ids, at=at, end=end: ",".join(str(ids[k]) for k in dict.fromkeys(o[at:end]))
            groups.append(f"{part(owner_a, a)}|{part(owner_b, b)}")
            at = end
        sides.append((len(a), len(b), groups))
        linked.append([(a[i], b[j]) for i, j in dict.fromkeys(zip(owner_a, owner_b, strict=True))])
    counts = Counter(p for links in linked for p in set(links))
    top = {}
    for (a, _), n in counts.items():
        top[a] = max(top.get(a, 0), n)
    out = []
    for i, ((n_a, n_b, groups), links) in enumerate(zip(sides, linked, strict=True)):
        said = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        out.append((i, n_a, n_b, len(groups), len(links), sum(counts[p] == top[p[0]] for p in links), sum(counts[p] for p in links), said))
    return out


@pytest.mark.parametrize("head", [align.HEAD_PAIRS, 7, 0])
def test_alignment_equals_brute_force(spark, head):
    got = align.align_report(docs(spark, TEXTS), head_pairs=head)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, got.collect())) == plain_alignment(TEXTS)


def test_alignment_of_repeated_and_unkeyed_rows(spark):
    rows = spark.createDataFrame([(None, "some words"), (4, "some words"), (4, "some words"), (5, "</s>▁x")], "doc_id long, text string")
    got = [(r["doc_id"], r["n_links"], r["count_sum"]) for r in align.align_report(rows).collect()]
    assert sorted(got, key=str) == [(4, 2, 6), (4, 2, 6), (5, 0, 0), (None, 2, 6)]


@pytest.mark.parametrize("case", ["none shared", "all shared", "far cut", "random"])
def test_cuts_by_divide_and_conquer(case):
    rng = np.random.default_rng(4)
    ends = {
        "none shared": (np.append(np.arange(1, 4000, 2), 9999), np.append(np.arange(2, 4000, 2), 9999)), "all shared": (np.arange(1, 3000), np.arange(1, 3000)),
        "far cut": (np.append(np.arange(1, 4000, 2), 9999), np.append(np.sort(np.append(np.arange(2, 4000, 2), 7)), 9999)),
        "random": (np.append(np.unique(rng.integers(1, 9000, 3000)), 9999), np.append(np.unique(rng.integers(1, 9000, 3000)), 9999)),
    }[case]
    found = align.shared_cuts(*ends, np.array([len(ends[0]) - 1]))
    assert ends[0][found].tolist() == np.intersect1d(*ends).tolist()


# --- hard negatives


def plain_mining(rows, positives=5, negatives=3):
    """rows: (id, label, vector, anchor), ids without null."""
    width = max((len(r[2]) for r in rows), default=0)
    x = [(*r[:2], [int(c) for c in r[2]] + [0] * (width - len(r[2])), r[3]) for r in rows]
    out = []
    for at, (q, label, v, anchor) in enumerate(x):
        if not anchor:
            continue
        scored = sorted((-sum(map(int.__mul__, v, w)), i, other) for k, (i, other, w, _) in enumerate(x) if k != at)
        for s, p, _ in [r for r in scored if r[2] == label][:positives]:
            fits = [r for r in scored if r[2] != label and -50 * s <= -100 * r[0] <= -95 * s][:negatives]
            out += [(q, p, n, i, -s, -t) for n, (t, i, _) in enumerate(fits, 1)]
    return sorted(out)


def clustered(n, seed, size=40):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 60, (n // size + 1, 6))
    return np.floor(centres[rng.integers(0, len(centres), n)] + rng.normal(0, 12, (n, 6))).astype(int).tolist()


def mined(spark, rows):
    frame = spark.createDataFrame([(i, a, v, k, 1) for i, a, v, k in rows], "id long, label int, v array<long>, anchor boolean, leaf int")
    return sorted(map(tuple, hardneg.mine(frame).collect()))


@pytest.mark.parametrize("case", ["clusters", "hot vector", "ties", "repeated rows", "uneven lengths", "few", "large numbers"])
def test_mining_equals_brute_force(spark, monkeypatch, case):
    for name, value in (("LEAF_ROWS", 12), ("ARITY", 4), ("BLOCK", 16), ("CHUNK", 5)):
        monkeypatch.setattr(hardneg, name, value)
    n = {"few": 3}.get(case, 260)
    v = clustered(n, 11)
    if case == "hot vector":
        v = [v[0] if i % 3 else x for i, x in enumerate(v)]
    if case == "ties":
        v = [[c // 40 for c in x] for x in v]
    if case == "uneven lengths":
        v = [x[: i % 7] for i, x in enumerate(v)]
    if case == "large numbers":
        v = [[c * 10**6 for c in x] for x in v]
    rows = [(i, i % 3, x, i % 9 == 0) for i, x in enumerate(v)]
    if case == "repeated rows":
        rows += rows[:40]
    assert mined(spark, rows) == plain_mining(rows)


def test_tree_leaves_out_what_cannot_match():
    rng = np.random.default_rng(2)
    x = np.array(clustered(4000, 8, 200), np.float64)
    tree = hardneg.Tree(x, float((x**2).sum(1).max()), 64, 8)
    leaf = tree.assign(tree.lift(x), widen=True)
    q = x[rng.integers(0, len(x), 30)]
    found = q @ x.T
    low, high = np.sort(found, axis=1)[:, -40], np.sort(found, axis=1)[:, -10]
    at = lambda s: np.sqrt((q**2).sum(1) + tree.most - 2 * s)
    seen = np.zeros((len(q), tree.leaves), bool)
    for k, members in tree.visits(np.concatenate([q, np.zeros((len(q), 1))], axis=1), at(high), at(low)):
        seen[members, k] = True
    wanted = (found >= low[:, None]) & (found <= high[:, None])
    assert all(seen[i, leaf[j]] for i, j in np.argwhere(wanted)) and seen.mean() < 0.6


def test_mining_edges(spark):
    none = spark.createDataFrame([], "id long, label int, v array<long>, anchor boolean")
    assert hardneg.mine(none).count() == 0 and hardneg.mine(none).columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert mined(spark, [(1, 0, [1, 2], False), (2, 1, [1, 2], False)]) == []
    assert mined(spark, [(1, 0, [], True), (2, 0, [], False), (3, 1, [], False)]) == [(1, 2, 1, 3, 0, 0)]
    unkeyed = [(0, 0, [10, 0], True), (1, 0, [10, 0], False), (None, 1, [7, 0], False), (9, 1, [7, 0], False)]
    frame = spark.createDataFrame(unkeyed, "id long, label int, v array<long>, anchor boolean")
    assert sorted(tuple(r)[:4] for r in hardneg.mine(frame).collect()) == [(0, 1, 1, 9), (0, 1, 2, None)]
