"""SentencePiece encoding and decoding with the N best segmentations.

The pieces and scores of a public model span a lattice over a text: edges are pieces, and
for a character without a piece its UTF-8 bytes. Forward Viterbi gives the best score up to
each position; a backward A* search that uses these scores as exact heuristics then yields
segmentations in falling order of score. A space becomes U+2581, and one is put in
front; a U+2581 of the text itself is spelled in bytes, so decoding gives back every text.

No piece crosses a pair of characters that occurs in no piece, so the lattice falls into
independent units there; the N best of a text are the best sums over its units. A* pops the
Viterbi path first, so units whose alternatives cannot reach the N best take that path at once,
and A* runs over the others.

The given model is a BPE model: its scores are minus the rank of a merge, and the library
encodes by merging in that order. Here the path with the highest sum of scores counts, which is
another one for most words: pieces of a low rank together often score more than one piece of a high
rank. The library's path lies in the same lattice, so it never scores more, and its decoder
gives back the same texts.

Edge cases: null or empty text: no pieces, score 0, one segmentation; fewer than N
segmentations: as many as there are; ties: fewer characters in the last piece first;
rows repeat; an empty table gives an empty result; only key and text are read.
"""

from __future__ import annotations

import heapq
import math
import re
import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairnspark.llm.common import small_batches, table

SPACE, N_BEST, UNKNOWN = "▁", 3, 10.0
#: Longest unit that goes through Viterbi with others of its length, and how many others are worth it.
LONG, FEW = 64, 12
_UNIT = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")


class Segmenter:
    """Best and n best segmentations. What it learns of at most max_units units is kept from batch to batch."""

    def __init__(self, path: str, n_best: int = N_BEST, max_units: int = 500_000):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.n_best, self.max_units = n_best, max_units
        size = model.get_piece_size()
        self.pieces: dict[str, tuple[int, float]] = {}
        self.bytes_ = [0] * 256
        self.spelled: list[bytes] = [b""] * size
        for i in range(size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.bytes_[int(piece[3:-1], 16)] = i
                self.spelled[i] = bytes([int(piece[3:-1], 16)])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                self.pieces[piece] = i, model.get_score(i)
                self.spelled[i] = piece.replace(SPACE, " ").encode()
        self.prefixes: dict = {p[:i]: () for p in self.pieces for i in range(1, len(p))}
        self.prefixes.update({p: (score, (i,)) for p, (i, score) in self.pieces.items()})
        self.joined = {p[i : i + 2] for p in self.pieces for i in range(len(p) - 1)}
        self.lowest = min(s for _, s in self.pieces.values()) - UNKNOWN
        self.word_start = not any(SPACE in p.lstrip(SPACE) for p in self.pieces)
        self._tables()
        self._forget()

    def _tables(self) -> None:
        """The prefixes as a trie for whole arrays: a sorted key of (state, character) gives the next state."""
        state = {p: i + 1 for i, p in enumerate(self.prefixes)} | {"": 0}
        keys = np.array([state[p[:-1]] << 21 | ord(p[-1]) for p in self.prefixes], np.int64)
        order = np.argsort(keys)
        self.steps, self.after = np.append(keys[order], np.iinfo(np.int64).max), np.append(order + 1, 0)
        self.piece_of = np.full(len(state), -1, np.int64)
        self.score_of = np.full(len(state), -np.inf)
        for p, (i, s) in self.pieces.items():
            self.piece_of[state[p]], self.score_of[state[p]] = i, s
        self.longest = max(map(len, self.pieces))

    def _forget(self) -> None:
        raw = SPACE.encode()
        # the empty unit stands for a U+2581 of the text itself
        self.ids = {"": np.array([self.bytes_[b] for b in raw], "<u4").tobytes()}
        self.score: dict[str, float] = {"": self.lowest * len(raw)}
        self.gap: dict[str, float] = {"": math.inf}
        self.behind: dict[str, list[float]] = {}

    def _forward(self, unit: str) -> list[list[tuple[float, int, float, tuple[int, ...]]]]:
        """Viterbi: for each end position the edges that end there, best first, as (-score up to here, -start, score, ids)."""
        get, n = self.prefixes.get, len(unit)
        ends: list[list] = [[] for _ in range(n + 1)]
        best = 0.0
        for i in range(n):
            if i:
                here = ends[i]
                if len(here) > 1:
                    here.sort()
                best = here[0][0]
            for j in range(i + 1, n + 1):
                hit = get(unit[i:j])
                if hit is None:  # no piece starts so
                    break
                if hit:
                    ends[j].append((best - hit[0], -i, hit[0], hit[1]))
            if unit[i] not in self.pieces:
                raw = unit[i].encode("utf-8", "surrogatepass")
                s = self.lowest * len(raw)
                ends[i + 1].append((best - s, -i, s, tuple([self.bytes_[b] for b in raw])))
        ends[n].sort()
        return ends

    def lattice_best(self, unit: str, n: int) -> list[tuple[float, tuple[int, ...]]]:
        """The n best segmentations of a unit: forward Viterbi, then backward A*.

        A hypothesis is an edge with all that follows it. When it leaves the queue, only the best edge
        before it and its own next best sibling enter, so the queue stays short.
        """
        ends = self._forward(unit)
        found, serial, push = [], 0, heapq.heappush
        queue = [(ends[-1][0][0], 0, ends[-1], 0, 0.0, None)] if unit else []
        while queue:
            _, _, edges, rank, behind, path = heapq.heappop(queue)
            _, start, s, ids = edges[rank]
            if rank + 1 < len(edges):
                serial += 1
                push(queue, (edges[rank + 1][0] - behind, serial, edges, rank + 1, behind, path))
            behind += s
            path = (ids, path)
            if start:
                serial += 1
                edges = ends[-start]
                push(queue, (edges[0][0] - behind, serial, edges, 0, behind, path))
            else:
                out: list[int] = []
                while path is not None:
                    out += path[0]
                    path = path[1]
                found.append((behind, tuple(out)))
                if len(found) == n:
                    break
        return found

    def _learn(self, units: list[str]) -> None:
        """Ids and score of the best segmentation of each unit, and how far the second best is behind.

        The second best path takes the second edge at one node of the best path, and the best before it. Units of
        equal length go through Viterbi together; a long unit is cut where no piece crosses.
        """
        by_length: dict[int, list[str]] = {}
        whole: dict[str, list[str]] = {}
        for u in units:
            if len(u) > LONG:
                cuts = [i for i in range(1, len(u)) if u[i - 1 : i + 1] not in self.joined]
                if cuts:
                    whole[u] = [u[a:b] for a, b in zip([0, *cuts], [*cuts, len(u)], strict=True)]
                    continue
            by_length.setdefault(len(u), []).append(u)
        for part in set().union(*whole.values()).difference(self.ids) if whole else ():
            by_length.setdefault(len(part), []).append(part)
        for n, alike in by_length.items():
            if n > LONG or len(alike) < FEW:
                for u in alike:
                    self._learn_one(u)
            else:
                for i in range(0, len(alike), 8192):
                    self._learn_alike(n, alike[i : i + 8192])
        for u, parts in whole.items():
            self.ids[u] = b"".join(map(self.ids.__getitem__, parts))
            self.score[u] = sum(map(self.score.__getitem__, parts))
            self.gap[u] = min(map(self.gap.__getitem__, parts))

    def _learn_one(self, unit: str) -> None:
        ends, at, gap, path = self._forward(unit), len(unit), math.inf, []
        self.score[unit] = -ends[at][0][0]
        while at:
            here = ends[at]
            if len(here) > 1:
                gap = min(gap, here[1][0] - here[0][0])
            path.append(here[0][3])
            at = -here[0][1]
        flat = [i for x in reversed(path) for i in x]
        self.ids[unit], self.gap[unit] = struct.pack(f"<{len(flat)}I", *flat), gap

    def _learn_alike(self, n: int, units: list[str]) -> None:
        """_learn_one for many units of n characters: each step is taken for all of them at once."""
        chars = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), "<u4").reshape(-1, n).T.astype(np.int64)
        rows = np.arange(len(units))
        first, second = np.full((n + 1, len(units)), np.inf), np.full((n + 1, len(units)), np.inf)
        back, piece = np.zeros((n + 1, len(units)), np.int64), np.zeros((n + 1, len(units)), np.int64)
        first[0] = 0.0
        # where each start's walk through the trie stands, one more character each time an end position moves on
        states, scores, pieces = {}, {}, {}
        for i in range(n):
            at = np.zeros(len(units), np.int64)
            for d in range(1, min(self.longest, n - i) + 1):
                alive = rows if d == 1 else np.flatnonzero(at)
                if not len(alive):
                    break
                key = at[alive] << 21 | chars[i + d - 1][alive]
                hit = np.searchsorted(self.steps, key)
                now = np.where(self.steps[hit] == key, self.after[hit], 0)
                at[alive] = now
                good = alive[self.score_of[now] > -np.inf]
                if d == 1:
                    scores[i, 1], pieces[i, 1] = self.score_of[at].copy(), self.piece_of[at].copy()
                    for r in np.flatnonzero(scores[i, 1] == -np.inf):  # no piece for this character: its bytes
                        c = int(chars[i, r])
                        scores[i, 1][r] = self.lowest * len(chr(c).encode("utf-8", "surrogatepass"))
                        pieces[i, 1][r] = -1 - c
                    states[i, 1] = rows
                elif len(good):
                    states[i, d], scores[i, d], pieces[i, d] = good, self.score_of[at[good]], self.piece_of[at[good]]
        for j in range(1, n + 1):
            for d in range(1, min(self.longest, j) + 1):  # on ties the shorter last piece stays first
                if (j - d, d) not in states:
                    continue
                r = states[j - d, d]
                cost, best = first[j - d][r] - scores[j - d, d], first[j][r]
                better = cost < best
                second[j][r] = np.where(better, best, np.minimum(cost, second[j][r]))
                first[j][r] = np.where(better, cost, best)
                back[j][r] = np.where(better, d, back[j][r])
                piece[j][r] = np.where(better, pieces[j - d, d], piece[j][r])
        gap, at = np.full(len(units), np.inf), np.full(len(units), n)
        with np.errstate(invalid="ignore"):
            apart = second - first
        path = np.zeros((n, len(units)), np.int64)
        length = np.zeros(len(units), np.int64)
        while (go := np.flatnonzero(at)).size:
            here = at[go]
            gap[go] = np.minimum(gap[go], apart[here, go])
            path[n - 1 - length[go], go] = piece[here, go]
            length[go] += 1
            at[go] = here - back[here, go]
        order = path.T
        flat = order[np.arange(n) >= n - length[:, None]].astype("<u4").tobytes()
        ends = (length.cumsum() * 4).tolist()
        self.ids.update(zip(units, [flat[a:b] for a, b in zip([0, *ends], ends, strict=False)], strict=True))
        self.score.update(zip(units, (-first[n]).tolist(), strict=True))
        self.gap.update(zip(units, gap.tolist(), strict=True))
        for r in np.flatnonzero((order < 0).any(axis=1)).tolist():
            spelled = [[i] if i >= 0 else [self.bytes_[b] for b in chr(-1 - i).encode("utf-8", "surrogatepass")] for i in order[r, n - length[r] :].tolist()]
            self.ids[units[r]] = np.array(sum(spelled, []), "<u4").tobytes()

    def _gaps(self, units: list[str]) -> list[float]:
        """How far the second to n-th best segmentations of a text are behind its best.

        Only the n - 1 units with the nearest second best can take part; A* gives their n best.
        """
        n, out = self.n_best, [0.0]
        gaps = list(map(self.gap.__getitem__, units))
        for _ in range(n - 1):
            if not gaps or (least := min(gaps)) == math.inf:
                break
            i = gaps.index(least)
            gaps[i] = math.inf
            if (behind := self.behind.get(units[i])) is None:
                found = [s for s, _ in self.lattice_best(units[i], n)]
                behind = self.behind[units[i]] = [found[0] - s for s in found]
            out = sorted(a + b for a in out for b in behind)[:n]
        return out

    def _units(self, text: str | None) -> list[str]:
        """Units of a text: a word with the spaces before it."""
        if not text:
            return []
        if SPACE in text:
            parts = (" " + text).split(SPACE)
            return [u for i, part in enumerate(parts) for u in ([""] if i else []) + self._spaced(part)]
        if "  " in text or text[0] == " " or not self.word_start:
            return self._spaced(" " + text)
        return [SPACE + w for w in text.split(" ")]

    def _spaced(self, part: str) -> list[str]:
        marked = part.replace(" ", SPACE)
        return _UNIT.findall(marked) if self.word_start else [marked] * bool(marked)

    def encode_all(self, texts: Iterable[str | None]) -> list[tuple[bytes, int, list[float]]]:
        """For each text the ids of its best segmentation (unsigned 32-bit, little-endian), their number and the n best scores."""
        split = [self._units(t) for t in texts]
        if len(self.ids) > self.max_units:
            self._forget()
        self._learn(list(set().union(*split).difference(self.ids)))
        out = []
        for units in split:
            ids = b"".join(map(self.ids.__getitem__, units))
            best = float(sum(map(self.score.__getitem__, units)))
            out.append((ids, len(ids) // 4, [best - g for g in self._gaps(units)]))
        return out

    def encode(self, text: str | None) -> tuple[bytes, int, list[float]]:
        return self.encode_all([text])[0]

    def decode(self, ids: bytes) -> str:
        whole = b"".join(map(self.spelled.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        return whole.decode("utf-8", "surrogatepass")[1:]


_SEGMENTERS: dict = {}


def segmenter(path: str, n_best: int = N_BEST) -> Segmenter:
    if (path, n_best) not in _SEGMENTERS:
        _SEGMENTERS[path, n_best] = Segmenter(path, n_best)
    return _SEGMENTERS[path, n_best]


def default_model() -> str:
    return public_tokenizers.path("piece_bpe_32k.model")


def encode_texts(docs: DataFrame, key: str = "doc_id", text: str = "text", n_best: int = N_BEST, model: str | None = None) -> DataFrame:
    """(key, ids, n_pieces, scores, decoded) of every text; ids as in Segmenter.encode."""
    path = model or default_model()

    @F.pandas_udf("ids binary, n_pieces long, scores array<double>, decoded string")
    def encoded(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        s = segmenter(path, n_best)
        for texts in batches:
            out = [(ids, n, scores, s.decode(ids)) for ids, n, scores in s.encode_all(texts)]
            yield pd.DataFrame(out, columns=["ids", "n_pieces", "scores", "decoded"])

    small_batches(docs.sparkSession)
    return docs.select(F.col(key), encoded(F.col(text)).alias("e")).select(key, "e.*")


def op6_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_texts(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_pieces", F.crc32("ids").alias("ids_crc32"), "scores", F.sha2("decoded", 256).alias("decoded_sha256")
    )
