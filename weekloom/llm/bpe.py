"""BPE encoding as a streaming transducer with bounded lookahead, and incremental decoding.

Lookahead. Merges run in the order of the list. What stands right of a place can change what
happens left of it only through a chain of ever later merges, each taking as its right part a
token the one before took away or made. ``lookahead`` follows all such chains in one pass
over the merge list and returns the most bytes one can reach back. A token that ends that
far before the end of what has been read is final: it is emitted, and encoding goes on from
its end as from a start. So a pre-token of any length runs in constant memory; short ones,
the rule, are encoded at once and remembered in a table of bounded size.

Text is prepared as the tokenizer file says: added tokens are taken out as they stand, the
rest is put in NFC, white space becomes a space, upper case lower case, and the pattern's
matches are the pre-tokens. The last byte of a pre-token is its word-end variant.

Decoding. ``Decoder`` takes ids one at a time. Without a decoder in the file the library joins
the tokens' names by spaces; ``bytes_to_text`` gives the bytes the tokens stand for, with
incomplete characters held back until their bytes are there.

NULL counts as an empty text. Rows come back as they are, with columns more; input columns of
their names give way.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import json
import unicodedata
from array import array
from collections.abc import Iterator
from itertools import batched

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructType

from .text import pieces

REMEMBERED = 300_000
BATCH = 4096
PORTION = 1_024  # bytes of a pre-token beyond which it is streamed, and ids of one portion
SHORT = 48


def byte_names() -> list[str]:
    """The printable character that stands for each byte: itself, or one from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out, free = [], 256
    for b in range(256):
        out.append(chr(b if b in plain else free))
        free += b not in plain
    return out


class Bpe:
    """A tokenizer file's vocabulary and merges."""

    def __init__(self, content: str) -> None:
        file = json.loads(content)
        model = file["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix: str = model["end_of_word_suffix"] or ""
        names = byte_names()
        self.inner = [self.vocab[c] for c in names]
        self.last = [self.vocab[c + self.suffix] for c in names]
        self.added = {t["content"]: t["id"] for t in file["added_tokens"]}
        self.names = {i: t for t, i in {**self.vocab, **self.added}.items()}
        self.sizes = {i: len(t.removesuffix(self.suffix)) for t, i in self.vocab.items()}
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, (a, b) in enumerate(model["merges"]):
            self.merges[self.vocab[a], self.vocab[b]] = rank, self.vocab[a + b]
        split = next(p for p in file["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pattern = regex.compile(split["pattern"]["Regex"])
        self.specials = regex.compile("|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) or "(?!)")
        self.reach = self.lookahead()
        # Pre-tokens known, and those known before the table was last full.
        self.table: dict[str, tuple[bytes, bytes, int]] = {}
        self.older: dict[str, tuple[bytes, bytes, int]] = {}

    def lookahead(self) -> int:
        """Most bytes a change at the right end can reach back."""
        reach: dict[int, int] = {}
        for (a, b), (_, made) in self.merges.items():
            far = self.sizes[a] + reach.get(b, 0)
            reach[a], reach[made] = max(reach.get(a, 0), far), max(reach.get(made, 0), far)
        return max(reach.values(), default=1)

    def merged(self, ids: list[int]) -> list[int]:
        """All merges applied, lowest rank first, leftmost first."""
        if len(ids) > SHORT:
            return self._merged_long(ids)
        merges = self.merges
        ranks = [merges.get(p, NONE)[0] for p in zip(ids, ids[1:])]
        while ranks:
            best = min(ranks)
            if best == NONE[0]:
                break
            i = ranks.index(best)
            ids[i : i + 2] = [merges[ids[i], ids[i + 1]][1]]
            del ranks[i]
            if i:
                ranks[i - 1] = merges.get((ids[i - 1], ids[i]), NONE)[0]
            if i < len(ranks):
                ranks[i] = merges.get((ids[i], ids[i + 1]), NONE)[0]
        return ids

    def _merged_long(self, ids: list[int]) -> list[int]:
        """The same with a heap of pairs over a linked list."""
        n = len(ids)
        ids, after, before = list(ids), list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(*self.merges[p], i, p) for i, p in enumerate(zip(ids, ids[1:])) if p in self.merges]
        heap = [(rank, i, p) for rank, _, i, p in heap]
        heapq.heapify(heap)
        while heap:
            _, i, pair = heapq.heappop(heap)
            j = after[i]
            if ids[i] != pair[0] or j >= n or ids[j] != pair[1]:
                continue
            ids[i], ids[j] = self.merges[pair][1], -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for k in (before[i], i):
                if k >= 0 and after[k] < n and (p := (ids[k], ids[after[k]])) in self.merges:
                    heapq.heappush(heap, (self.merges[p][0], k, p))
        return [t for t in ids if t >= 0]

    def stream(self, word: bytes, window: int | None = None) -> Iterator[int]:
        """Tokens of a pre-token as they become final; holds one window of bytes."""
        window = max(window or 0, 2 * self.reach, 1)
        start = 0
        while len(word) - start > window:
            ids = self.merged([self.inner[b] for b in word[start : start + window]])
            done = 0
            for t in ids:
                if done + self.sizes[t] > window - self.reach:
                    break
                done += self.sizes[t]
                yield t
            start += done
        tail = word[start:]
        if tail:
            yield from self.merged([*(self.inner[b] for b in tail[:-1]), self.last[tail[-1]]])

    def pretokens(self, text: str) -> Iterator[str | int]:
        """Pre-tokens in order, and the ids of added tokens between them."""
        start = 0
        for hit in self.specials.finditer(text):
            yield from self.pattern.findall(prepared(text[start : hit.start()]))
            yield self.added[hit.group()]
            start = hit.end()
        yield from self.pattern.findall(prepared(text[start:] if start else text))

    def encode(self, text: str) -> Iterator[int]:
        for word in self.pretokens(text):
            if isinstance(word, int):
                yield word
            else:
                yield from self.stream(word.encode())

    def known(self, word: str) -> tuple[bytes, bytes, int]:
        """(ids as little-endian words, names joined by spaces, number) of a pre-token."""
        found = self.table.get(word)
        if found is None:
            found = self.older.get(word)
            if found is None:
                ids = list(self.stream(word.encode()))
                found = pack(ids), " ".join([self.names[t] for t in ids]).encode(), len(ids)
            if len(self.table) >= REMEMBERED:
                self.table, self.older = {}, self.table
            if len(word) <= SHORT:
                self.table[word] = found
        return found


    def portions(self, text: str) -> Iterator[tuple[bytes, bytes, int]]:
        """A text's tokens as :meth:`known` gives them, long pre-tokens in portions as they are final."""
        known = self.known
        for word in self.pretokens(text):
            if isinstance(word, int):
                yield pack([word]), self.names[word].encode(), 1
            elif len(word) <= PORTION:
                yield known(word)
            else:
                for ids in batched(self.stream(word.encode()), PORTION):
                    yield pack(ids), " ".join([self.names[t] for t in ids]).encode(), len(ids)


NONE = (1 << 62, -1)


def prepared(text: str) -> str:
    """NFC and lower case; a capital sigma is lowered alike wherever it stands."""
    if text.isascii():
        return text.lower()
    if not unicodedata.is_normalized("NFC", text):
        text = unicodedata.normalize("NFC", text)
    return text.replace("Σ", "σ").lower()


def pack(ids: list[int]) -> bytes:
    packed = array("I", ids)
    return packed.tobytes()


class Decoder:
    """Incremental: ids in, text out as soon as it is certain."""

    def __init__(self, model: Bpe) -> None:
        self.model = model
        self.bytes = {c: b for b, c in enumerate(byte_names())}
        self.partial = codecs.getincrementaldecoder("utf-8")("replace")

    def bytes_to_text(self, token: int) -> str:
        """Text that the token completes; word ends become a space."""
        name = self.model.names[token]
        if name in self.model.added:
            return self.partial.decode(b"", True) + name
        ends = bool(self.model.suffix) and name.endswith(self.model.suffix)
        raw = bytes(self.bytes[c] for c in (name.removesuffix(self.model.suffix) if ends else name))
        return self.partial.decode(raw, ends) + (" " if ends else "")

    def rest(self) -> str:
        return self.partial.decode(b"", True)


_LOADED: dict[str, Bpe] = {}


def load(content: str) -> Bpe:
    """The tokenizer, kept by the worker between tasks."""
    key = hashlib.sha256(content.encode()).hexdigest()
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Bpe(content)
    return _LOADED[key]


def _with(docs: DataFrame, path: str, fields: list, make) -> DataFrame:
    docs = docs.drop(*(f[0] for f in fields))
    with open(path, encoding="utf-8") as file:  # a vocabulary file, read where the job starts
        sent = docs.sparkSession.sparkContext.broadcast(file.read())
    columns = docs.columns
    schema = StructType(list(docs.schema.fields))
    for name, kind in fields:
        schema = schema.add(name, kind)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(sent.value)
        for batch in pieces(batches):
            made = [make(model, t or "") for t in batch.column("text").to_pylist()]
            arrays = [pa.array(x, schema_[name]) for x, (name, _) in zip(zip(*made), fields)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), *arrays], names=[*columns, *(f[0] for f in fields)])

    schema_ = {n: {"int": pa.int64(), "ids": pa.list_(pa.int32())}.get(_KINDS[type(k)], pa.string()) for n, k in fields}
    return docs.withColumn("text", F.col("text").cast("string")).mapInArrow(rows, schema)


_KINDS = {LongType: "int", ArrayType: "ids", StringType: "text"}


def encode_decode(docs: DataFrame, path: str) -> DataFrame:
    """Every row with ``ids``, ``tokens`` (names joined by spaces) and ``decoded`` text."""

    def make(model: Bpe, text: str):
        ids = list(model.encode(text))
        decoder = Decoder(model)
        return ids, " ".join([model.names[t] for t in ids]), "".join([decoder.bytes_to_text(t) for t in ids]) + decoder.rest()

    return _with(docs, path, [("ids", ArrayType(IntegerType())), ("tokens", StringType()), ("decoded", StringType())], make)


def digests(docs: DataFrame, path: str) -> DataFrame:
    """Every row with n_tokens and the SHA-256 of its ids and of its tokens joined by spaces.

    Ids and names go into the digests as they are emitted. The table keeps those of short
    pre-tokens; a long one is streamed in portions and never held whole.
    """

    def make(model: Bpe, text: str):
        ids, names, n, first = hashlib.sha256(), hashlib.sha256(), 0, True
        for some in batched(model.portions(text), BATCH):
            ids.update(b"".join([f[0] for f in some]))
            names.update((b"" if first else b" ") + b" ".join([f[1] for f in some]))
            n += sum([f[2] for f in some])
            first = False
        return n, ids.hexdigest(), names.hexdigest()

    return _with(docs, path, [("n_tokens", LongType()), ("ids_sha256", StringType()), ("decoded_sha256", StringType())], make)
