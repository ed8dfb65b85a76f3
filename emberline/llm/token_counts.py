"""Operator 2: exact token counts at every prefix of a text, by dynamic programming over prefixes.

The last token of the byte-pair encoding of a byte string is the only vocabulary entry ``t`` that ends it and can
follow the last token of what is before ``t``: two tokens can stand side by side if encoding their joined bytes
gives the same two.  So ``count(p) = count(p without t) + 1``, and one pass over the prefixes of a piece gives
the count of each.  A prefix of a text is a sequence of whole pieces and one cut piece, so counts of prefixes of
the text are sums; they are stored as one signed byte per code point, the change of the count at it.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import in_worker, small_batches, table

#: How the byte-level vocabulary file spells bytes (printable bytes as themselves, the rest from U+0100 on).
_PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
SPELLED = {chr(b): b for b in _PRINTABLE} | {chr(0x100 + k): b for k, b in enumerate(b for b in range(256) if b not in set(_PRINTABLE))}

#: A run of white space with the piece that takes its last space, or a piece. The suffixes after an apostrophe.
_UNIT = r"'(?:[stmd]|re|ve|ll)|(?:\p{White_Space}* )?(?:\p{L}+|\p{N}+|[^\p{White_Space}\p{L}\p{N}]+)|\p{White_Space}+"


class PrefixCounter:
    """Token counts of all prefixes of texts under one byte-level BPE vocabulary (a ``tokenizers`` file)."""

    def __init__(self, path: str, cap: int = 500_000):
        import regex

        with open(path, encoding="utf-8") as f:
            data = json.load(f)
        spell = lambda s: bytes(SPELLED[c] for c in s)
        merges = [tuple(map(spell, m.split(" ") if isinstance(m, str) else m)) for m in data["model"]["merges"]]
        # tokens by the order in which merges make them: single bytes first, each its own half
        self.order = {bytes([b]): b for b in range(256)}
        for k, (x, y) in enumerate(merges):
            self.order.setdefault(x + y, 256 + k)
        self.halves = {b: (b, b) for b in range(256)} | {256 + k: (self.order[x], self.order[y]) for k, (x, y) in enumerate(merges)}
        self.merged = {pair: k for k, pair in reversed(self.halves.items()) if k > 255}
        self.special = sorted(x["content"] for x in data["added_tokens"] if x["special"])
        self.units, self.run = regex.compile(_UNIT), regex.compile(r"\p{White_Space}*")
        self.specials = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.longest: dict[bytes, int] = {}
        for t in self.order:
            self.longest[t[-2:]] = max(self.longest.get(t[-2:], 1), len(t))
        self.cap = cap
        self.joins: dict[tuple[int, int], bool] = {}
        self.state: dict[bytes, tuple[int, int, bytes]] = {b"": (0, -1, b"")}
        self.inner: dict[str, bytes] = {}

    def _joins(self, a: int, b: int) -> bool:
        """Whether tokens ``a`` and ``b`` stay as they are side by side.

        The merges that made both are undone, latest first; if at any time an earlier merge than the one undone
        would have joined the two parts at the seam, encoding would have taken it.  With nothing before ``b``,
        the seam is inside it: its halves must be the ones that encoding finds.
        """
        if a < 0:
            x, y = self.halves[b]
            return b < 256 or (self._joins(-1, x) and self._joins(-1, y) and self.merged[x, y] == b and self._joins_below(x, y, b))
        return self._joins_below(a, b, 1 << 40)

    def _joins_below(self, a: int, b: int, limit: int) -> bool:
        halves, merged = self.halves, self.merged
        while True:
            if merged.get((a, b), limit) < limit:
                return False
            if a < 256 and b < 256:
                return True
            # of two equal tokens the left one is merged first, so the right one is undone first
            if a > b:
                limit, a = min(limit, a), halves[a][1]
            else:
                limit, b = min(limit, b + 1), halves[b][0]

    def prefix(self, p: bytes) -> tuple[int, int, bytes]:
        """Count, last token and changes by code point of the prefix ``p`` of a piece, after all shorter prefixes."""
        state = self.state
        found = state.get(p)
        if found:
            return found
        known = len(p) - 1
        while p[:known] not in state:
            known -= 1
        joins, order, longest, n_all = self.joins, self.order, self.longest, len(p)
        marks = state[p[:known]][2]
        whole = state[p[:known]][0]  # count at the last whole code point
        if known and known < n_all and p[known] & 0xC0 == 0x80:
            back = known
            while p[back] & 0xC0 == 0x80:
                back -= 1
            whole = state[p[:back]][0]
        for i in range(known + 1, n_all + 1):
            for n in range(min(i, longest.get(p[i - 2 if i > 1 else 0 : i], 1)), 0, -1):
                t = order.get(p[i - n : i])
                if t is not None:
                    count, last, _ = state[p[: i - n]]
                    ok = joins.get((last, t))
                    if ok is None:
                        ok = joins[last, t] = self._joins(last, t)
                    if ok:
                        count += 1
                        if i == n_all or p[i] & 0xC0 != 0x80:
                            marks += bytes(((count - whole) & 255,))
                            whole = count
                        found = state[p[:i]] = (count, t, marks)
                        break
            else:
                raise ValueError(f"the vocabulary can't spell {p!r}")
        return found

    def _long(self, p: bytes) -> bytes:
        """Changes in a piece that is too long to keep the states of its prefixes by their bytes: the same pass over places."""
        order, joins, longest = self.order, self.joins, self.longest
        counts, lasts, marks, whole = [0], [-1], bytearray(), 0
        for i in range(1, len(p) + 1):
            for n in range(min(i, longest.get(p[i - 2 if i > 1 else 0 : i], 1)), 0, -1):
                t = order.get(p[i - n : i])
                if t is not None:
                    last = lasts[i - n]
                    ok = joins.get((last, t))
                    if ok is None:
                        ok = joins[last, t] = self._joins(last, t)
                    if ok:
                        counts.append(counts[i - n] + 1)
                        lasts.append(t)
                        break
            else:
                raise ValueError(f"the vocabulary can't spell {p[:i]!r}")
            if i == len(p) or p[i] & 0xC0 != 0x80:
                marks.append((counts[i] - whole) & 255)
                whole = counts[i]
        return bytes(marks)

    def _piece(self, piece: str) -> bytes:
        """Changes in one piece; the suffixes after an apostrophe are cut apart until they are whole."""
        data = piece.encode()
        if len(data) > 64:
            return self._long(data)
        if piece in ("'re", "'ve", "'ll"):
            return bytes((1, 1, (self.prefix(data)[0] - 2) & 255))
        return self.prefix(data)[2]

    def _unit(self, unit: str, end: bool) -> bytes:
        """Changes at each code point of a unit; ``end``: nothing follows it.

        A run of white space that something follows is split before its last character, which shows only at the
        next character: if that is in another unit, one byte more carries the difference there.
        """
        space = self.run.match(unit).end()
        if space < 2 and space < len(unit):
            return self._piece(unit)
        run = self._piece(unit[:space])
        if space == 1 or space == len(unit) and end:
            return run
        carry = self.prefix(unit[space - 1 : space].encode())[0] - (run[-1] - 256 * (run[-1] > 127))
        if space == len(unit):
            return run + bytes((carry & 255,))
        rest = self._piece(unit[space - 1 :])[1:]
        return run + bytes(((rest[0] + carry) & 255,)) + rest[1:]

    def changes(self, text: str) -> bytes:
        """One signed byte per code point of ``text``: by how much the token count of the prefix changes at it."""
        if len(self.state) > 2 * self.cap or len(self.joins) > 2 * self.cap:
            self.state, self.joins = {b"": (0, -1, b"")}, {}
        if len(self.inner) > self.cap:
            self.inner.clear()
        if self.specials is None or not any(s in text for s in self.special):
            return self._plain(text)
        out, parts = [], self.specials.split(text)
        for before, special in zip(parts[::2], parts[1::2]):
            # until its last character the string is ordinary text, and may share a piece with what is before it
            cut = np.frombuffer(self._plain(before + special[:-1]), np.int8)
            whole = int(cut[: len(before)].sum()) + 1
            out.append(cut.tobytes() + np.array([whole - int(cut.sum())], np.int8).tobytes())
        return b"".join(out) + self._plain(parts[-1])

    def _plain(self, text: str) -> bytes:
        units = self.units.findall(text)
        if not units:
            return b""
        last = units.pop()
        inner = self.inner
        for u in set(units).difference(inner):
            inner[u] = self._unit(u, False)
        parts = list(map(inner.__getitem__, units))
        if len(text) > 4096:
            for u in [u for u in set(units) if len(u) > 64]:  # long ones are not worth their room
                del inner[u]
        parts.append(self._unit(last, True))
        out = b"".join(parts)
        if len(out) != len(text):
            out = self._carried(units, parts)
        return out

    @staticmethod
    def _carried(units: list[str], parts: list[bytes]) -> bytes:
        """Moves the extra byte of a split run to the first character after it."""
        out, carry = [], 0
        for u, p in zip([*units, None], parts):
            if carry:
                p = np.array([p[0] - 256 * (p[0] > 127) + carry], np.int8).tobytes() + p[1:]
                carry = 0
            if u is not None and len(p) > len(u):
                carry = p[-1] - 256 * (p[-1] > 127)
                p = p[:-1]
            out.append(p)
        return b"".join(out)


def prefix_counts(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, n_bytes, n_tokens, changes (binary: one signed byte per code point) for every row of ``docs``.

    A null text counts as empty: no bytes, no tokens, no changes.  Rows are kept as they come, repeated ids too;
    other columns are not read; an empty table gives an empty result.  Texts are taken whole, however long.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = in_worker(("prefixes", tokenizer), lambda: PrefixCounter(tokenizer))
        for batch in batches:
            for part in (batch.slice(k, 512) for k in range(0, batch.num_rows, 512)):
                texts = [x or "" for x in part.column(1).to_pylist()]
                changes = [c.changes(x) for x in texts]
                sums = [int(np.frombuffer(x, np.int8).sum(dtype=np.int64)) for x in changes]
                sizes = [len(x.encode()) for x in texts]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sizes, pa.int64()), pa.array(sums, pa.int64()), pa.array(changes, pa.binary())], names=["doc_id", "n_bytes", "n_tokens", "changes"])

    return small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(count, "doc_id long, n_bytes long, n_tokens long, changes binary")


def counts_at(changes: bytes) -> np.ndarray:
    """Token count of the prefix of each length from 0 on."""
    return np.concatenate([[0], np.cumsum(np.frombuffer(changes, np.int8), dtype=np.int64)])


def longest_prefix(changes: bytes, budget: int) -> int:
    """Code points of the longest prefix that takes ``budget`` tokens or fewer: a truncation point, without encoding."""
    return int(np.flatnonzero(counts_at(changes) <= budget)[-1])


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    out = prefix_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return out.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 1024).alias("over_limit"), (F.length("changes")).cast("long").alias("n_prefixes"))
