"""SentencePiece encoding and decoding for merge-type vocabularies."""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SP = "▁"
NONE = np.int32(2**31 - 1)
MARK = "\ue000"  # set between segments while a text is cut; texts that hold it are cut by the pattern


class PieceCodec:
    """Encodes by merging adjacent symbols, best-scored pair first, leftmost of equals.

    The vocabulary's own boundaries cut a text into segments: no piece holds a space behind another
    character, and none joins a line feed to anything, so no merge can cross such a place (both are
    checked when the vocabulary is read; where one fails, texts are cut less). Segments repeat, so
    their ids are kept in a bounded memo; the new segments of a batch are merged together, one
    agenda a row, and compared with the sentencepiece library, ids and decoded text. Where a segment
    differs, the texts that hold it take the library's ids. The memo is emptied at `memo` bytes, and
    segments of over 64 characters are forgotten after their slice.
    """

    def __init__(self, path: str, memo: int = 80_000_000):
        import sentencepiece

        self.lib = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.lib.get_piece_size()
        self.pieces = [self.lib.id_to_piece(i) for i in range(n)]
        plain = [i for i in range(n) if not (self.lib.is_byte(i) or self.lib.is_control(i) or self.lib.is_unknown(i) or self.lib.is_unused(i))]
        if any(self.lib.is_unused(i) for i in range(n)):
            raise ValueError("unused pieces are not supported")
        self.of = {self.pieces[i]: i for i in plain}
        self.byte = np.full(256, self.lib.unk_id(), np.int64)
        for i in range(n):
            if self.lib.is_byte(i):
                self.byte[int(self.pieces[i][3:-1], 16)] = i
        self.surface = [bytes([int(p[3:-1], 16)]) if self.lib.is_byte(i) else b"" if self.lib.is_control(i) else p.replace(SP, " ").encode() for i, p in enumerate(self.pieces)]
        # Symbols: pieces by id, then characters that occur in pieces but are none themselves.
        chars = {c for p in self.of for c in p}
        sym = dict(self.of)
        for c in sorted(chars - sym.keys()):
            sym[c] = n + len(sym) - len(self.of)
        self.n, self.char = n, np.full(0x110000, -1, np.int32)
        for c in chars:
            self.char[ord(c)] = sym[c]
        order = sorted({self.lib.get_score(i) for i in plain}, reverse=True)
        level = {s: k for k, s in enumerate(order)}
        pairs = {}
        for p, i in self.of.items():
            for k in range(1, len(p)):
                if p[:k] in sym and p[k:] in sym:
                    pairs[sym[p[:k]] << 32 | sym[p[k:]]] = (i, level[self.lib.get_score(i)])
        keys = np.array(sorted(pairs), np.int64)
        self.keys = keys
        self.made = np.array([pairs[k][0] for k in keys.tolist()], np.int32)
        self.rank = np.array([pairs[k][1] for k in keys.tolist()], np.int32)
        self.pairs = pairs
        inner = any(SP in p.lstrip(SP) for p in self.of)
        lf = any("\n" in p and len(p) > 1 for p in self.of)
        self.cut = re.compile("\n|[^\n]+" if inner and not lf else f"{SP}*[^{SP}]+|{SP}+" if lf and not inner else f"[\\s\\S]+" if inner else f"\n|{SP}*[^{SP}\n]+|{SP}+")
        self.lf_alone = not lf
        self.simple = not lf and not inner
        self.memo: dict[str, bytes] = {}
        self.most, self.kept = memo, 0
        self.odd: set[str] = set()

    def _look(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rank of each pair (NONE where it makes no piece) and the piece it makes."""
        key = (left.astype(np.int64) << 32) | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        ok = (self.keys[at] == key) & (left >= 0) & (right >= 0)
        return np.where(ok, self.rank[at], NONE), self.made[at]

    def _merge_rows(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Symbols left in each of many short segments: symbols and code points in order, and how many a segment."""
        size = np.array([len(w) for w in words])
        m, w = len(words), int(size.max())
        code = np.zeros((m, w), np.uint32)
        cols = np.arange(w)
        inside = cols < size[:, None]
        code[inside] = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        sym = np.where(inside, self.char[code], -1)
        alive = inside.copy()
        nxt = np.tile(cols + 1, (m, 1))
        prv = np.tile(cols - 1, (m, 1))
        rank = np.full((m, w), NONE, np.int32)
        made = np.zeros((m, w), np.int32)
        if w > 1:
            rank[:, :-1], made[:, :-1] = self._look(sym[:, :-1], sym[:, 1:])
        rows = np.arange(m)
        while len(rows):
            j = rank[rows].argmin(axis=1)
            go = rank[rows, j] < NONE
            rows, j = rows[go], j[go]
            if not len(rows):
                break
            k = nxt[rows, j]
            after = nxt[rows, k]
            sym[rows, j] = made[rows, j]
            alive[rows, k] = False
            rank[rows, k] = NONE
            nxt[rows, j] = after
            in_row = after < w
            prv[rows[in_row], after[in_row]] = j[in_row]
            right = np.where(in_row, sym[rows, np.minimum(after, w - 1)], -1)
            rank[rows, j], made[rows, j] = self._look(sym[rows, j], right)
            before = prv[rows, j]
            has = before >= 0
            r, b = rows[has], before[has]
            rank[r, b], made[r, b] = self._look(sym[r, b], sym[r, j[has]])
        return sym[alive], code[alive], alive.sum(axis=1)

    def _merge_one(self, word: str) -> list[int]:
        """The agenda as a heap, for a long segment."""
        code = [ord(c) for c in word]
        sym = [int(self.char[c]) for c in code]
        nxt, prv = list(range(1, len(sym) + 1)), list(range(-1, len(sym) - 1))
        agenda: list[tuple[int, int, int, int, int]] = []

        def put(a: int, b: int) -> None:
            if a >= 0 and b < len(sym) and sym[a] >= 0 and sym[b] >= 0 and (hit := self.pairs.get(sym[a] << 32 | sym[b])):
                heapq.heappush(agenda, (hit[1], a, sym[a], sym[b], hit[0]))

        for a in range(len(sym) - 1):
            put(a, a + 1)
        while agenda:
            _, a, left, right, made = heapq.heappop(agenda)
            b = nxt[a]
            if sym[a] != left or b >= len(sym) or sym[b] != right:
                continue
            sym[a], sym[b], nxt[a] = made, -2, nxt[b]
            if nxt[a] < len(sym):
                prv[nxt[a]] = a
            put(prv[a], a)
            put(a, nxt[a])
        return [i for a, s in enumerate(sym) if s != -2 for i in self._ids(s, code[a])]

    def _ids(self, symbol: int, code: int) -> list[int]:
        """A symbol's ids: its own, or those of its bytes where it is no piece."""
        if 0 <= symbol < self.n:
            return [symbol]
        return [int(self.byte[b]) for b in chr(code).encode("utf-8")]

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids: pieces with their spaces, bytes as UTF-8; the space that encoding adds in front goes."""
        text = b"".join(map(self.surface.__getitem__, ids.tolist())).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text

    def learn(self, new: list[str]) -> None:
        """Encodes segments that are not in the memo, together, and checks them against the library."""
        order: list[str] = []
        flat, sizes = [], []
        for lo, hi in ((0, 8), (8, 16), (16, 40)):
            group = [s for s in new if lo < len(s) <= hi]
            for a in range(0, len(group), 20_000):
                part = group[a : a + 20_000]
                sym, code, count = self._merge_rows(part)
                order += part
                odd = np.flatnonzero((sym < 0) | (sym >= self.n))
                if len(odd):  # characters that are no piece become bytes
                    row = np.repeat(np.arange(len(part)), count)
                    long = {int(k): self._ids(-1, int(code[k])) for k in odd}
                    wide = np.ones(len(sym), np.int64)
                    wide[odd] = [len(v) for v in long.values()]
                    out = np.repeat(sym, wide)
                    at = np.cumsum(wide) - wide
                    for k, v in long.items():
                        out[at[k] : at[k] + len(v)] = v
                    sym, count = out, np.bincount(row, wide, len(part)).astype(np.int64)
                flat.append(sym)
                sizes.append(count)
        for s in new:
            if len(s) > 40:
                order.append(s)
                flat.append(np.array(self._merge_one(s)))
                sizes.append(np.array([len(flat[-1])]))
        ids, size = np.concatenate(flat).astype("<u4"), np.concatenate(sizes)
        if not self._same(order, ids, size):
            start = np.cumsum(size) - size
            self.odd |= {s for s, a, n in zip(order, start.tolist(), size.tolist(), strict=True) if not self._same([s], ids[a : a + n], np.array([n]))}
        end = np.cumsum(size) * 4
        packed = ids.tobytes()
        self.memo.update(zip(order, map(packed.__getitem__, map(slice, (end - size * 4).tolist(), end.tolist())), strict=True))

    def _same(self, order: list[str], ids: np.ndarray, size: np.ndarray) -> bool:
        """Whether the library encodes segments, and decodes their ids, alike.

        Line feeds between the segments keep them apart in one text; where a line feed may merge,
        only segments that start with one space are compared, one by one.
        """
        if self.lf_alone:
            text = "\n" + "\n".join(order)
            theirs = np.array(self.lib.encode(text), "<u4")
            lf = np.array(self.lib.encode("\n"), "<u4")
            start = np.cumsum(size) - size
            ours = np.insert(ids, np.repeat(start, len(lf) - 1), np.tile(lf[1:], len(order)))
            return np.array_equal(theirs, np.concatenate([lf[:1], ours])) and self.lib.decode(theirs.tolist()) == self.decode(theirs)
        part = np.split(ids, np.cumsum(size)[:-1])
        return all(self.lib.encode(s[1:]) == x.tolist() for s, x in zip(order, part, strict=True) if s[0] == SP and len(s) > 1)

    def segments(self, text: str) -> list[str]:
        """Some of the segments may be empty."""
        if not text:
            return []
        text = SP + text.replace(" ", SP)
        if self.simple and SP + SP not in text and MARK not in text:
            return text.replace("\n", f"{MARK}\n{MARK}").replace(SP, MARK + SP).split(MARK)
        return self.cut.findall(text)

    def by_library(self, text: str) -> tuple[bytes, str]:
        ids = self.lib.encode(text, add_bos=True, add_eos=True)
        return np.array(ids, "<u4").tobytes(), self.lib.decode(ids)

    def run(self, texts: list[str]) -> Iterator[tuple[bytes, str]]:
        """For each text the packed ids with begin and end, and the text that they decode to."""
        bos, eos = (np.array([i], "<u4").tobytes() for i in (self.lib.bos_id(), self.lib.eos_id()))
        memo = self.memo
        if self.kept > self.most:
            memo.clear()
            self.odd.clear()
            self.kept = 0
        memo[""] = b""
        cut = [self.segments(t) for t in texts]
        new = set().union(*cut).difference(memo)
        if new:
            self.learn(list(new))
            self.kept += sum(200 + 2 * len(s) for s in new)
        for t, c in zip(texts, cut, strict=True):
            if self.odd and not self.odd.isdisjoint(c):
                yield self.by_library(t)
                continue
            ids = b"".join([bos, *map(memo.__getitem__, c), eos])
            yield ids, self.decode(np.frombuffer(ids, "<u4"))
        for s in new:
            if len(s) > 64:
                del memo[s]
                self.odd.discard(s)
                self.kept -= 200 + 2 * len(s)


_codecs: dict[str, PieceCodec] = {}


def _codec(path: str) -> PieceCodec:
    if path not in _codecs:
        _codecs[path] = PieceCodec(path)
    return _codecs[path]


def encode_pieces(
    docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False, carry: tuple[str, ...] = ()
) -> DataFrame:
    """Encodes whole texts with begin and end ids and decodes them again: (doc_id, n_tokens, ids_sha256, decoded_sha256).

    keep_ids adds `ids` (packed little-endian unsigned 32-bit) and `decoded`. Null text is empty:
    its ids are begin and end. model_path must be readable on every executor. Batches are worked
    through in slices of about a million characters, so memory is bounded by the longest text.
    One text of each slice is compared with the library as a whole, besides every new segment; where
    either differs, the text takes the library's ids. A row for each input row: repeated rows and
    equal texts get equal results, an empty table gives an empty one, and columns that are not in
    carry are ignored, whatever their names.
    """
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), *[F.col(c).alias(f"_c_{c}") for c in carry])
    extra = ", binary('') as ids, '' as decoded" if keep_ids else ""
    schema = own.drop("text").selectExpr("*", "0L as n_tokens", "'' as ids_sha256", "'' as decoded_sha256", *([x for x in extra.split(", ") if x])).schema

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(model_path)
        for whole in batches:
            a = 0
            while a < whole.num_rows:
                b, size, texts = a, 0, []
                while b < whole.num_rows and (b == a or size < 1_000_000):
                    texts.append(whole.column(1)[b].as_py() or "")
                    size += len(texts[-1])
                    b += 1
                got = list(codec.run(texts))
                if (first := codec.by_library(texts[0])) != got[0]:
                    got = [first, *map(codec.by_library, texts[1:])]
                part = whole.slice(a, b - a)
                cols = [part.column(0), *part.columns[2:]]
                cols += [
                    pa.array([len(i) // 4 for i, _ in got], pa.int64()),
                    pa.array([hashlib.sha256(i).hexdigest() for i, _ in got], pa.string()),
                    pa.array([hashlib.sha256(t.encode()).hexdigest() for _, t in got], pa.string()),
                ]
                if keep_ids:
                    cols += [pa.array([i for i, _ in got], pa.binary()), pa.array([t for _, t in got], pa.string())]
                yield pa.RecordBatch.from_arrays(cols, names=schema.names)
                a = b

    out = own.mapInArrow(work, schema)
    return out.select(*[F.col(c).alias(c.removeprefix("_c_")) for c in out.columns])
