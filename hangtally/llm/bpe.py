"""BPE encoding by dynamic programming over prefixes, and decoding.

Plain BPE merges pairs in rank order. Its result for every prefix of a word ends in one certain
token, and a sequence is the result exactly if all its neighbours are compatible: no merge across
their border would have come before the merges that made them. So the encoder walks over the
matches of an automaton of all tokens (a trie with suffix links, which reports every token that is
a suffix of the prefix read so far), keeps the one compatible last token of each prefix, and
follows the back-pointers from the end.

Cases: null text is an empty text, with no ids and an empty decoded text. Special strings inside a
text become their ids, as in the public library. Repeated rows give repeated rows. Texts of any
length are encoded whole; only words up to 64 characters are remembered between texts, and beyond a task if
they are few. An empty table gives an empty result. Further columns of any name are not read.
"""

from __future__ import annotations

import json
import sys
from array import array
from collections.abc import Iterator, Sequence

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hangtally.llm.common import batch, frugal, prepare
from hangtally.llm.words import Memo, Splitter, byte_letters

#: Words, and pairs of tokens, up to which a worker remembers them beyond a task.
KEPT = 200_000
_END = 0x1000   # added to the code of a word's last letter


def packed(ids: list[int]) -> bytes:
    a = array("I", ids)
    if sys.byteorder == "big":
        a.byteswap()
    return a.tobytes()


class Bpe:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        suffix = model.get("end_of_word_suffix") or ""
        vocab: dict[str, int] = model["vocab"]
        self.splitter = Splitter(path)
        self.text_of = {i: t for t, i in vocab.items()} | {i: t for t, i in self.splitter.special.items()}
        letters = byte_letters()
        self._letter = [letters[b] for b in range(256)]
        # tokens numbered by the order in which merging can make them: letters first, then the merges
        number: dict[str, int] = {}
        for c in self._letter:
            for s in (c, c + suffix):
                if s in vocab:
                    number.setdefault(s, len(number))
        self.letters = len(number)
        left, right = list(range(self.letters)), list(range(self.letters))
        self._pairs: dict[int, int] = {}
        self._width = width = len(number) + len(model["merges"])
        for a, b in (m if not isinstance(m, str) else m.split(" ") for m in model["merges"]):
            made = number.setdefault(a + b, len(number))
            if made == len(left):
                left.append(number[a])
                right.append(number[b])
            self._pairs.setdefault(number[a] * width + number[b], made)
        self._left, self._right = left, right
        self._id = [vocab[s] for s in number]
        # a token that merging never leaves whole can't be part of a result
        usable = bytearray(b"\x01" * len(left))
        automaton = ahocorasick.Automaton()
        for s, t in number.items():
            if t >= self.letters:
                usable[t] = usable[left[t]] and usable[right[t]] and self.compatible(left[t], right[t], t)
            if usable[t]:
                key = s[:-len(suffix)] if suffix and s.endswith(suffix) else s
                if key is not s:
                    key = key[:-1] + chr(ord(key[-1]) + _END)
                automaton.add_word(key, (t, len(key)))
        automaton.make_automaton()
        self._automaton = automaton
        self._ends = bool(suffix)
        self._special = {s: packed([i]) for s, i in self.splitter.special.items()}
        self._apart = Memo(lambda pair: self.compatible(*divmod(pair, width)), 500_000)
        self._known = Memo(self.word, 500_000)

    def compatible(self, a: int, b: int, limit: int = 1 << 60) -> bool:
        """Whether tokens a and b stay apart side by side; merges from ``limit`` on don't count."""
        pairs, width = self._pairs, self._width
        while True:
            made = pairs.get(a * width + b)
            if made is not None and made < limit:
                return False
            # undo the later of the two merges and look at the parts at the border
            if a > b:
                if a < self.letters:
                    return True
                limit, a = a, self._right[a]
            else:
                if b < self.letters:
                    return True
                limit, b = b + 1, self._left[b]

    def word(self, word: str) -> bytes:
        """Ids of one word as little-endian unsigned 32-bit integers."""
        s = "".join(map(self._letter.__getitem__, word.encode()))
        if self._ends:
            s = s[:-1] + chr(ord(s[-1]) + _END)
        n, width, apart = len(s), self._width, self._apart
        last, back = [-1] * (n + 1), [0] * (n + 1)
        for end, (t, size) in self._automaton.iter(s):
            end += 1
            if last[end] >= 0:
                continue   # the last token of this prefix is known, and there is only one
            start = end - size
            if start == 0 or ((before := last[start]) >= 0 and apart[before * width + t]):
                last[end], back[end] = t, start
        out, at = [], n
        while at:
            out.append(self._id[last[at]])
            at = back[at]
        return packed(out[::-1])

    def encode(self, text: str) -> bytes:
        known, out = self._known, []
        for k, part in enumerate(self.splitter.parts(text)):
            if k % 2:
                out.append(self._special[part])
            elif part:
                out.extend(map(known.__getitem__, self.splitter.words(part)))
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        """Without a decoder in its file, a tokenizer sets single spaces between its tokens."""
        return " ".join(map(self.text_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_LOADED: dict[str, Bpe] = {}


def loaded(path: str) -> Bpe:
    if path not in _LOADED:
        _LOADED[path] = Bpe(path)
    return _LOADED[path]


def forget() -> None:
    """Drops the words and pairs that this worker remembers if they are many; the models stay."""
    for b in _LOADED.values():
        for m in (b._apart, b._known):
            if len(m) > KEPT:
                m.clear()


def _mapped(docs: DataFrame, keep: Sequence[str], source: str, made: list[T.StructField], fn) -> DataFrame:
    """Rows of ``keep`` with columns that ``fn`` makes from the values of ``source``, in slices of bounded size."""
    schema = T.StructType([docs.schema[c] for c in keep] + made)

    @frugal
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema
        arrow = to_arrow_schema(schema)
        try:
            for b in batches:
                for at in range(0, b.num_rows, 250):
                    part = b.slice(at, 250)
                    values = fn(part.column(len(keep)).to_pylist())
                    yield batch(arrow, *part.columns[:-1], *values)
        finally:
            forget()

    return docs.select(*keep, F.col(source).alias("_value")).mapInArrow(work, schema)


def encode(docs: DataFrame, path: str, text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``keep`` and the column ``ids`` (binary: little-endian unsigned 32-bit ids of the whole text)."""
    prepare(docs.sparkSession)

    def fn(texts):
        e = loaded(path).encode
        return [[e(t or "") for t in texts]]

    return _mapped(docs, keep, text, [T.StructField("ids", T.BinaryType())], fn)


def decode(encoded: DataFrame, path: str, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``keep`` and the column ``decoded`` from the column ``ids``; null ids decode to the empty text."""
    prepare(encoded.sparkSession)

    def fn(ids):
        d = loaded(path).decode
        return [[d(i or b"") for i in ids]]

    return _mapped(encoded, keep, "ids", [T.StructField("decoded", T.StringType())], fn)


def round_trip(docs: DataFrame, path: str, text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``encode`` and then ``decode`` of its ids in one pass over the texts: ``keep``, ``ids``, ``decoded``."""
    prepare(docs.sparkSession)

    def fn(texts):
        b = loaded(path)
        ids = [b.encode(t or "") for t in texts]
        return [ids, [b.decode(i) for i in ids]]

    return _mapped(docs, keep, text, [T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.StringType())], fn)


def digests(coded: DataFrame) -> DataFrame:
    """Counts and digests of ``round_trip``."""
    return coded.select("doc_id", F.expr("cast(octet_length(ids) div 4 as bigint)").alias("n_tokens"),
                        F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
