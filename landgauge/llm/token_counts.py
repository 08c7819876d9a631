"""Exact token counts at every prefix of a text, by dynamic programming over the pieces of a BPE model.

The encoding of a prefix ends in exactly one piece: the piece that may follow the last piece of the shorter
prefix it leaves, where "may follow" means that encoding the two together gives the two again. So the state
of a prefix is its last piece, and its count is one more than that of the prefix before the piece. Two characters
that stand side by side in no piece are never joined, so texts are cut there into independent segments (words,
mostly). The distinct segments of a batch are worked out in order, each from the prefix it shares with the one
before, and their counts are kept by hash from batch to batch. Truncation and budget questions are then
look-ups in the counts, without encoding anything again.

Null and empty texts have no tokens. Text is taken whole, however long.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from landgauge.llm import bytesops as B
from landgauge.llm.common import lists, mapped, pieces, table, utf8

MARK = "▁"
#: Segments and pairs of pieces that a task keeps; beyond it a table starts anew.
KEPT = 1_500_000


class PrefixCounter:
    """Token counts of all prefixes of a text, in characters, for a sentencepiece BPE model."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        m = self.model
        usable = [i for i in range(m.get_piece_size()) if not (m.is_control(i) or m.is_unknown(i) or m.is_byte(i))]
        #: A piece's rank is its score; merges of higher scores come first.
        self.score = {m.id_to_piece(i): m.get_score(i) for i in usable}
        #: Lengths of the pieces by their last three characters (two where there are no three), longest first.
        lengths: dict[str, set[int]] = {}
        #: Whether two bytes, side by side in a text, always belong to different pieces.
        self.apart = np.zeros((256, 256), bool)
        self.apart[:128, :128] = True
        self.apart[128:, 32] = True
        self.apart[MARK.encode()[-1], 32] = False  # the mark itself in a text is as good as a blank
        for p in self.score:
            lengths.setdefault(p[-3:], set()).add(len(p))
            plain = p.replace(MARK, " ")
            for x, y in zip(plain, plain[1:]):
                if ord(x) < 128 and ord(y) < 128:
                    self.apart[ord(x), ord(y)] = False
                elif y == " ":
                    self.apart[128:, 32] = False
        pairs = {k for k in lengths if len(k) == 2}
        self.lengths = {k: (2, 1) for k in pairs}
        for k, v in lengths.items():
            if len(k) == 3:
                self.lengths[k] = tuple(sorted(v | ({2, 1} if k[1:] in pairs else {1}), reverse=True))
        self.ends: dict[str, tuple[list[str], list[str]] | None] = {}
        self.follows: dict[tuple[str, str], bool] = {}
        #: Token counts of segments, sorted by the segments' hashes.
        self.names, self.counts = np.empty(0, np.uint64), np.empty(0, np.int64)

    def grow(self, piece: str) -> tuple[list[str], list[str]] | None:
        """How the piece's left and right ends grow, from one character to the whole; None if merging never
        arrives at it. Merges go by score, leftmost first."""
        if piece in self.ends:
            return self.ends[piece]
        parts, left, right = list(piece), [piece[:1]], [piece[-1:]]
        while len(parts) > 1:
            joins = [self.score.get(x + y) for x, y in zip(parts, parts[1:])]
            best = max((s for s in joins if s is not None), default=None)
            if best is None:
                break
            at = joins.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            if at == 0:
                left.append(parts[0])
            if at == len(parts) - 1:
                right.append(parts[-1])
        grown = self.ends[piece] = (left, right) if len(parts) == 1 else None
        return grown

    def may_follow(self, left: str, right: str) -> bool:
        """Whether the two pieces, side by side, stay two: at no time does the end of the left one join the
        start of the right one before either of them grows on."""
        pair = (left, right)
        fine = self.follows.get(pair)
        if fine is not None:
            return fine
        if len(self.follows) > KEPT:
            self.follows.clear()
        fine = self.follows[pair] = self.stay_apart(left, right)
        return fine

    def stay_apart(self, left: str, right: str) -> bool:
        grown_left, grown_right = self.grow(left), self.grow(right)
        if grown_left is None or grown_right is None:
            return False
        ends, starts, score = grown_left[1], grown_right[0], self.score
        i = j = 0
        while True:
            more_left = score[ends[i + 1]] if i + 1 < len(ends) else None
            more_right = score[starts[j + 1]] if j + 1 < len(starts) else None
            joined = score.get(ends[i] + starts[j])
            if joined is not None and (more_left is None or joined > more_left) and (more_right is None or joined >= more_right):
                return False
            if more_left is None and more_right is None:
                return True
            if more_right is None or more_left is not None and more_left >= more_right:
                i += 1
            else:
                j += 1

    def solve(self, segments: Iterable[str]):
        """For sorted segments: each with the counts of its prefixes of length 0 to all. The list is reused."""
        score, follows, lengths = self.score, self.follows, self.lengths
        counts, last, before = [0], [""], ""
        for text in segments:
            same = 0
            for x, y in zip(before, text):
                if x != y:
                    break
                same += 1
            del counts[same + 1 :], last[same + 1 :]
            for end in range(same + 1, len(text) + 1):
                tail = lengths.get(text[end - 3 : end] if end > 2 else text[:end])
                if tail is None:
                    tail = lengths.get(text[end - 2 : end], (1,)) if end > 2 else (1,)
                    if len(lengths) < KEPT:
                        lengths[text[max(0, end - 3) : end]] = tail
                for n in tail:
                    start = end - n
                    if start < 0:
                        continue
                    piece = text[start:end]
                    if n > 1 and piece not in score:
                        continue
                    if start:
                        fine = follows.get((last[start], piece))
                        if not (self.may_follow(last[start], piece) if fine is None else fine):
                            continue
                    elif self.grow(piece) is None:
                        continue
                    # A character the model lacks becomes one token for each of its bytes.
                    counts.append(counts[start] + (1 if piece in score else len(piece.encode())))
                    last.append(piece)
                    break
            before = text
            yield text, counts

    def segments(self, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The texts with the blank the model sets before each of them, and starts and ends of their segments."""
        full = np.diff(offsets) > 0
        firsts = offsets[:-1][full] + np.arange(int(full.sum()))
        out = np.empty(len(buf) + len(firsts), np.uint8)
        own = np.ones(len(out), bool)
        own[firsts] = False
        out[firsts] = 32
        out[own] = buf
        if len(out) == 0:
            return out, np.empty(0, np.int64), np.empty(0, np.int64)
        cut = np.empty(len(out), bool)
        cut[0] = True
        cut[1:] = self.apart[out[:-1], out[1:]]
        cut[firsts] = True
        starts = np.flatnonzero(cut)
        return out, starts, np.append(starts[1:], len(out))

    def totals(self, buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Tokens of each text."""
        out, starts, ends = self.segments(buf, offsets)
        hashes = B.range_hash(B.prefix_sums(out), starts, ends, out)
        order = np.argsort(hashes)
        ranked = hashes[order]
        new = np.ones(len(ranked), bool)
        new[1:] = ranked[1:] != ranked[:-1]
        if len(self.names) > KEPT:
            self.names, self.counts = self.names[:0], self.counts[:0]
        distinct, example = ranked[new], order[new]
        at = np.searchsorted(self.names, distinct)
        held = np.append(self.names, np.uint64(0))[at] == distinct
        held &= at < len(self.names)
        found = np.append(self.counts, 0)[np.where(held, at, -1)]
        missing = np.flatnonzero(~held)
        if len(missing):
            raw = out.tobytes()
            # Segments with a blank and with the mark for it differ in bytes, but are one text to the model.
            place: dict[str, list[int]] = {}
            first, last = starts[example[missing]].tolist(), ends[example[missing]].tolist()
            for i, a, z in zip(missing.tolist(), first, last):
                place.setdefault(raw[a:z].decode().replace(" ", MARK), []).append(i)
            for text, counts in self.solve(sorted(place)):
                for i in place[text]:
                    found[i] = counts[-1]
            self.names = np.insert(self.names, at[missing], distinct[missing])
            self.counts = np.insert(self.counts, at[missing], found[missing])
        each = np.empty(len(starts), np.int64)
        each[order] = found[np.cumsum(new) - 1] if len(ranked) else 0
        sums = np.concatenate([[0], np.cumsum(each)])
        shift = np.concatenate([[0], np.cumsum(np.diff(offsets) > 0)])
        at = np.searchsorted(starts, offsets + shift)
        return sums[at[1:]] - sums[at[:-1]]

    def prefixes(self, text: str) -> np.ndarray:
        """The token count of text[:k] for k = 0 ... len(text)."""
        data = np.frombuffer(text.encode(), np.uint8)
        out, starts, ends = self.segments(data, np.array([0, len(data)]))
        raw = out.tobytes()
        parts = [raw[a:b].decode().replace(" ", MARK) for a, b in zip(starts, ends)]
        solved = {s: np.array(c[1:], np.int64) for s, c in self.solve(sorted(set(parts)))}
        total, counts = 0, []
        for s in parts:
            counts.append(solved[s] + total)
            total += int(solved[s][-1])
        flat = np.concatenate(counts) if counts else np.zeros(1, np.int64)
        flat[0] = 0  # the blank the model sets before a text, with no text yet
        return flat

    def truncation(self, text: str, limit: int) -> int:
        """Characters of the longest prefix of at most ``limit`` tokens (counts may fall within a word)."""
        return int(np.flatnonzero(self.prefixes(text) <= limit)[-1])


_counters: dict[str, PrefixCounter] = {}


def counter(path: str) -> PrefixCounter:
    """One per worker process, so that segments stay known from task to task."""
    if path not in _counters:
        _counters[path] = PrefixCounter(path)
    return _counters[path]


def token_counts(docs: DataFrame, model_path: str, limit: int = 4096) -> DataFrame:
    """Per document: doc_id, n_bytes, n_tokens, fits_chars (characters of the longest prefix of ``limit`` tokens)."""
    kind = [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("fits_chars", pa.int64())]

    def work(batches):
        c = counter(model_path)
        for b in pieces(batches, 4 << 20):
            buf, offsets = utf8(b.column("text"))
            tokens = c.totals(buf, offsets)
            starts = np.concatenate([[0], np.cumsum((buf & 0xC0) != 0x80)])[offsets]
            fits = np.diff(starts)
            for i in np.flatnonzero(tokens > limit):
                fits[i] = c.truncation(b.column("text")[int(i)].as_py(), limit)
            yield table(kind, b.column("doc_id"), np.diff(offsets), tokens, fits)

    return mapped(docs.select("doc_id", "text"), work, "doc_id long, n_bytes long, n_tokens long, fits_chars long")


def prefix_counts(docs: DataFrame, model_path: str) -> DataFrame:
    """Per document: doc_id, counts (token count of every prefix, in characters, from the empty one on)."""
    kind = [("doc_id", pa.int64()), ("counts", pa.list_(pa.int64()))]

    def work(batches):
        c = counter(model_path)
        for b in pieces(batches, 256 << 10):
            arrays = [c.prefixes(t or "") for t in b.column("text").to_pylist()]
            flat = np.concatenate(arrays) if arrays else np.empty(0, np.int64)
            yield table(kind, b.column("doc_id"), lists(flat, np.array([len(a) for a in arrays], np.int64), pa.int64()))

    return mapped(docs.select("doc_id", "text"), work, "doc_id long, counts array<long>")
