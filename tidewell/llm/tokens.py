"""Token counts by rank-synchronous array merging.

Pre-tokens are ragged numpy arrays of symbols.  In each round every pre-token finds the lowest rank among its adjacent
pairs and merges that pair wherever it stands; pre-tokens without a ranked pair are done.  What survives is counted.
Counts of pre-tokens seen before in a task come from a bounded memo.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Pre-tokens, and their characters, that a task remembers the counts of; beyond either, it starts anew.
MEMO, MEMO_CHARS = 600_000, 8_000_000
#: Characters of new pre-tokens that are merged together.
BATCH_CHARS = 2_000_000
_NONE = np.int64(2**62)


class PieceModel:
    """Merge ranks of a BPE piece model with byte fallback, spaces written as U+2581 and one put before the text."""

    SPACE = "▁"

    def __init__(self, path: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        special = lambda i: model.is_control(i) or model.is_unknown(i) or model.is_byte(i)
        pieces = {model.id_to_piece(i): model.get_score(i) for i in range(model.get_piece_size()) if not special(i)}
        symbols = {p: i for i, p in enumerate(pieces)}
        for p in list(pieces):
            for c in p:
                symbols.setdefault(c, len(symbols))
        pairs: list[tuple[int, int, float, int]] = []
        for p, score in pieces.items():
            pairs += [(symbols[p[:k]], symbols[p[k:]], -score, symbols[p]) for k in range(1, len(p)) if p[:k] in symbols and p[k:] in symbols]
        ranks = {s: i for i, s in enumerate(sorted({x[2] for x in pairs}))}  # equal scores have equal ranks
        self.shift = np.int64(max(1, len(symbols)).bit_length())
        key = np.array([(a << int(self.shift)) | b for a, b, _, _ in pairs], np.int64)
        order = np.argsort(key)
        self.rank = np.array([ranks[x[2]] for x in pairs], np.int64)[order]
        self.merged = np.array([x[3] for x in pairs], np.int64)[order]
        self._table(key[order])
        self.chars = {s: i for s, i in symbols.items() if len(s) == 1}
        is_piece = {i for s, i in symbols.items() if s in pieces}
        # a symbol that is no piece falls back to its bytes
        self.width = np.ones(len(symbols) + 5, np.int64)
        for s, i in symbols.items():
            if i not in is_piece:
                self.width[i] = len(s.encode())
        self.unknown = len(symbols)  # + the number of UTF-8 bytes
        self.width[self.unknown :] = np.arange(5)
        #: A character that no longer piece holds never merges.
        self.newline = self.width[self.chars["\n"]] if "\n" in self.chars else 1
        self.newline_alone = not any("\n" in p for p in pieces if len(p) > 1)

    def _table(self, key: np.ndarray) -> None:
        """Open addressing: slots of 1 + the pair's number."""
        self.key = key
        bits = int(max(4, len(key)).bit_length() + 2)
        self.move = np.uint64(64 - bits)
        self.slots = np.zeros(1 << bits, np.int32)
        todo, at = np.arange(len(key)), self._slot(key)
        while len(todo):
            free = self.slots[at] == 0
            self.slots[at[free]] = todo[free] + 1
            lost = self.slots[at] != todo + 1
            todo, at = todo[lost], (at[lost] + 1) & (len(self.slots) - 1)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.move).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The pair's number, -1 without one."""
        key = (left << self.shift) | right
        at = self._slot(key)
        found = self.slots[at].astype(np.int64) - 1
        wrong = np.flatnonzero((found >= 0) & (self.key[found] != key))
        while len(wrong):
            at[wrong] = (at[wrong] + 1) & (len(self.slots) - 1)
            found[wrong] = self.slots[at[wrong]].astype(np.int64) - 1
            wrong = wrong[(found[wrong] >= 0) & (self.key[found[wrong]] != key[wrong])]
        return found

    def count(self, pretokens: list[str]) -> np.ndarray:
        """Symbols that survive in each pre-token; unmergeable ones without a piece count their bytes."""
        out = np.zeros(len(pretokens), np.int64)
        lengths = np.fromiter(map(len, pretokens), np.int64, len(pretokens))
        code = np.frombuffer("".join(pretokens).encode("utf-32-le"), np.uint32)
        distinct, where = np.unique(code, return_inverse=True)
        number = np.array([self.chars.get(chr(c), self.unknown + (1 if c < 128 else 2 if c < 2048 else 3 if c < 65536 else 4)) for c in distinct.tolist()], np.int64)
        sym, seq = number[where] if len(code) else np.zeros(0, np.int64), np.repeat(np.arange(len(pretokens)), lengths)
        while len(sym):
            same = seq[1:] == seq[:-1]
            pair = np.where(same, self.find(sym[:-1], sym[1:]), -1)
            rank = np.append(np.where(pair >= 0, self.rank[pair], _NONE), _NONE)
            first = np.flatnonzero(np.append(True, ~same))
            lowest = np.minimum.reduceat(rank, first)
            run = np.diff(np.append(first, len(sym)))
            done = np.repeat(lowest == _NONE, run)
            if done.any():
                np.add.at(out, seq[done], self.width[sym[done]])
                keep = ~done
                sym, seq, rank, pair = sym[keep], seq[keep], rank[keep], np.append(pair, -1)[keep]
                run, lowest = run[lowest != _NONE], lowest[lowest != _NONE]
                if not len(sym):
                    break
                first = np.cumsum(run) - run
            else:
                pair = np.append(pair, -1)
            at = np.flatnonzero(rank == np.repeat(lowest, run))
            # of pairs that share a rank, the leftmost one's kind; of its overlapping places, every other one
            owner = seq[at]
            lead = np.append(True, owner[1:] != owner[:-1])
            kind = pair[at][np.flatnonzero(lead)][np.cumsum(lead) - 1]
            at = at[pair[at] == kind]
            start = np.append(True, np.diff(at) != 1)
            since = np.arange(len(at)) - np.flatnonzero(start)[np.cumsum(start) - 1]
            at = at[since % 2 == 0]
            sym[at] = self.merged[pair[at]]
            keep = np.ones(len(sym), bool)
            keep[at + 1] = False
            sym, seq = sym[keep], seq[keep]
        return out

    def pretokens(self, text: str) -> tuple[list[str], int]:
        """Parts of a text that never merge with each other, and the tokens beside them.

        No piece holds U+2581 after another character, so a part ends where one begins; a line break stands alone.
        """
        if not text:
            return [], 0
        space = self.SPACE
        extra, parts = 0, []
        text = space + text.replace(" ", space)
        lines = text.split("\n") if self.newline_alone else [text]
        extra = (len(lines) - 1) * int(self.newline)
        for line in lines:
            head, *rest = line.split(space)
            if head:
                parts.append(head)
            if "" in rest:  # several spaces, or one at the end: they belong to what follows
                run = ""
                for word in rest:
                    run += space
                    if word:
                        parts.append(run + word)
                        run = ""
                if run:
                    parts.append(run)
            else:
                parts += map(space.__add__, rest)
        return parts, extra


_models: dict[str, PieceModel] = {}


def piece_model(path: str) -> PieceModel:
    if path not in _models:
        _models[path] = PieceModel(path)
    return _models[path]


COUNTS = "doc_id long, n_bytes long, n_tokens long"


def count_tokens(docs: DataFrame, model_path: str) -> DataFrame:
    """n_bytes (UTF-8) and n_tokens of every row of ``docs(doc_id, text, ...)`` under the piece model at ``model_path``,
    without begin or end tokens; strings of special tokens inside a text are ordinary text.  ``model_path`` must be
    readable on the workers.  Null and empty texts have 0 of both.  Repeated rows count each; an empty table gives an
    empty result."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(model_path)
        memo: dict[str, int] = {}
        remembered = 0
        for batch in batches:
            n_bytes, n_tokens = [], []
            held: list[tuple[list[str], int]] = []
            chars = 0

            def settle() -> None:
                nonlocal remembered
                new = list({p for parts, _ in held for p in parts if p not in memo})
                at = 0
                while at < len(new):
                    end, size = at, 0
                    while end < len(new) and (end == at or size + len(new[end]) <= BATCH_CHARS):
                        size += len(new[end])
                        end += 1
                    memo.update(zip(new[at:end], model.count(new[at:end]).tolist(), strict=True))
                    remembered += size
                    at = end
                n_tokens.extend(sum(map(memo.__getitem__, parts)) + extra for parts, extra in held)
                held.clear()
                if len(memo) > MEMO or remembered > MEMO_CHARS:
                    memo.clear()
                    remembered = 0

            for text in batch.column(1).to_pylist():
                text = text or ""
                n_bytes.append(len(text.encode()))
                held.append(model.pretokens(text))
                chars += len(text)
                if chars > 4 * BATCH_CHARS:
                    settle()
                    chars = 0
            settle()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(scan, COUNTS)


def over_limit(docs: DataFrame, model_path: str, limit: int = 4096) -> DataFrame:
    """:func:`count_tokens` with ``over_limit``: more than ``limit`` tokens."""
    return count_tokens(docs, model_path).withColumn("over_limit", F.col("n_tokens") > limit)
