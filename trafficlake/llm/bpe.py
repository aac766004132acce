"""Byte-pair encoding and decoding by a contiguous rank array.

A word is held as the list of its parts and the list of the ranks of adjacent parts. The smallest rank is looked
up again and again (the leftmost of equal ones), the boundary there is deleted and the two neighbouring ranks are
refreshed. Short words are what texts consist of, and for them scanning a short list beats any heap. A word of more
than ``SHORT`` parts goes through a heap instead, which gives the same merges without quadratic time.

Words repeat, so each Python worker keeps the ids of words it has met, packed in bytes. That memory is bounded: it is
emptied when full, which changes speed only. Whole texts are encoded; a NULL text counts as empty and has no ids. Rows repeat,
tie or share ids freely: each row is encoded on its own, and there is no shuffle. An empty table gives an empty result; columns
named as a result are replaced, others are kept.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trafficlake.llm.frames import with_results

SHORT = 64
KEPT_WORDS = 150_000
ROWS_PER_BATCH = 256
BITS = 24
LOW = (1 << BITS) - 1
NO_RANK = 1 << 62

# Characters whose properties no Unicode version has changed; texts with others are split by the library, whose tables
# decide what counts as a letter.
COMMON = [*range(0x530), *range(0x2010, 0x2028), *range(0x2030, 0x205F), *range(0x20A0, 0x20C0)]
OTHER = re.compile(r"[^\x00-\u052f\u2010-\u2027\u2030-\u205e\u20a0-\u20bf]")
# Fixed value: what this vocabulary's normaliser takes as white space, within the common characters.
WHITE_SPACE = "\t\n\x0b\x0c\r \x85\xa0"


def _word_pattern() -> re.Pattern:
    """A run of letters, one number, the endings 's 't 'm 'd 're 've 'll, or a run of anything else but white space."""
    of = lambda kind: "".join(re.escape(chr(c)) for c in COMMON if unicodedata.category(chr(c))[0] == kind)
    letters, numbers = of("L"), of("N")
    return re.compile(f"[{letters}]+|[{numbers}]|'(?:[stmd]|re|ve|ll)|[^{letters}{numbers}{WHITE_SPACE}]+")


def byte_symbols() -> list[str]:
    """The visible character that stands for each byte: itself where printable, else the next one from 256 on."""
    printable = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    spare = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


def _pack(ids: list[int]) -> bytes:
    return np.array(ids, np.int32).tobytes()


class WordBpe:
    """Encoder and decoder of one vocabulary file of the ``tokenizers`` library with word ends."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.path = path
        model = spec["model"]
        vocab = model["vocab"]
        self.end = model["end_of_word_suffix"] or ""
        # both sides of a pair in one number, and its rank with what it merges to in another: they compare fast
        self.merges = {}
        for rank, (left, right) in enumerate(model["merges"]):
            pair = vocab[left] << BITS | vocab[right]
            self.merges.setdefault(pair, rank << BITS | vocab[left + right])
        symbols = byte_symbols()
        self.inner = [vocab[s] for s in symbols]
        self.last = [vocab[s + self.end] for s in symbols]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.tokens = [""] * size
        for token, i in chain(vocab.items(), self.special.items()):
            self.tokens[i] = token
        self.word = _word_pattern()
        self.specials = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        self.known: dict[str, bytes] = {}
        self._library = None

    # -- words ---------------------------------------------------------------------------------------------------

    def encode_word(self, word: str) -> list[int]:
        data = word.encode("utf-8")
        parts = [self.inner[b] for b in data]
        parts[-1] = self.last[data[-1]]
        return self._scan(parts) if len(parts) <= SHORT else self._heap(parts)

    def _scan(self, parts: list[int]) -> list[int]:
        rank_of = self.merges.get
        ranks = [rank_of(a << BITS | b, NO_RANK) for a, b in zip(parts, parts[1:], strict=False)]
        while ranks and (best := min(ranks)) != NO_RANK:
            i = ranks.index(best)
            parts[i] = merged = best & LOW
            del parts[i + 1], ranks[i]
            if i:
                ranks[i - 1] = rank_of(parts[i - 1] << BITS | merged, NO_RANK)
            if i < len(ranks):
                ranks[i] = rank_of(merged << BITS | parts[i + 1], NO_RANK)
        return parts

    def _heap(self, parts: list[int]) -> list[int]:
        n, merges = len(parts), self.merges
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        alive = [True] * n
        heap = []

        def push(i: int) -> None:
            j = after[i]
            if j < n and (found := merges.get(parts[i] << BITS | parts[j])) is not None:
                heapq.heappush(heap, (found, i, parts[i], parts[j]))

        for i in range(n):
            push(i)
        while heap:
            found, i, left, right = heapq.heappop(heap)
            j = after[i]
            if not alive[i] or j >= n or parts[i] != left or parts[j] != right:
                continue
            parts[i], alive[j], after[i] = found & LOW, False, after[j]
            if after[j] < n:
                before[after[j]] = i
            if before[i] >= 0:
                push(before[i])
            push(i)
        return [p for p, a in zip(parts, alive, strict=True) if a]

    # -- texts ---------------------------------------------------------------------------------------------------

    def words(self, text: str) -> list[str]:
        if OTHER.search(text):
            if self._library is None:
                from tokenizers import Tokenizer

                self._library = Tokenizer.from_file(self.path)
            plain = self._library.normalizer.normalize_str(text)
            return [plain[a:b] for _, (a, b) in self._library.pre_tokenizer.pre_tokenize_str(plain)]
        plain = unicodedata.normalize("NFC", text)
        # lower case goes by characters: no other form of sigma at the end of a word
        lower = "".join([c.lower() for c in plain]) if "Σ" in plain else plain.lower()
        return self.word.findall(lower)

    def packed(self, text: str | None) -> bytes:
        """The ids of a text as 32-bit numbers in a row."""
        text = text or ""
        if not any(s in text for s in self.special):
            return self._packed_words(text)
        parts = self.specials.split(text)
        return b"".join([_pack([self.special[p]]) if p in self.special else self._packed_words(p) for p in parts])

    def _packed_words(self, text: str) -> bytes:
        words, known = self.words(text), self.known
        try:
            return b"".join(map(known.__getitem__, words))
        except KeyError:
            if len(known) > KEPT_WORDS:
                known.clear()
            for word in set(words).difference(known):
                known[word] = _pack(self.encode_word(word))
        return b"".join(map(known.__getitem__, words))

    def encode(self, text: str | None) -> list[int]:
        return np.frombuffer(self.packed(text), np.int32).tolist()

    def decode(self, ids: Iterable[int]) -> str:
        """Tokens joined by a space, as the vocabulary names no decoder; special tokens stay."""
        return " ".join(map(self.tokens.__getitem__, ids))


_loaded: dict[str, WordBpe] = {}


def load(path: str) -> WordBpe:
    """One encoder per Python worker and file."""
    if path not in _loaded:
        _loaded[path] = WordBpe(path)
    return _loaded[path]


def _lists(rows: list[bytes]) -> pa.Array:
    """Packed ids as an Arrow array of lists."""
    offsets = np.zeros(len(rows) + 1, dtype=np.int32)
    np.cumsum([len(r) // 4 for r in rows], out=offsets[1:])
    flat = np.frombuffer(b"".join(rows), np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, type=pa.int32()))


def encode_column(text: Column, path: str) -> Column:
    """Token ids of each text, as array<int>; never NULL."""

    @F.arrow_udf("array<int>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = load(path)
        for batch in batches:
            yield _lists([bpe.packed(t.as_py()) for t in batch])

    return encode(text)


def decode_column(ids: Column, path: str) -> Column:
    """Text of token ids; NULL ids count as none."""

    @F.arrow_udf("string")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = load(path)
        for batch in batches:
            flat, sizes = batch.flatten().to_numpy(), pc.fill_null(pc.list_value_length(batch), 0).to_numpy()
            ends = np.cumsum(sizes)
            yield pa.array([bpe.decode(flat[e - n : e].tolist()) for e, n in zip(ends, sizes, strict=True)], type=pa.string())

    return decode(ids)


def coded_column(text: Column, path: str) -> Column:
    """Token ids of each text and the text they decode to, in one pass through one Python worker."""

    @F.arrow_udf("struct<ids:array<int>,decoded:string>")
    def code(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = load(path)
        for batch in batches:
            rows = [bpe.packed(t.as_py()) for t in batch]
            texts = pa.array([bpe.decode(np.frombuffer(r, np.int32).tolist()) for r in rows], type=pa.string())
            yield pa.StructArray.from_arrays([_lists(rows), texts], ["ids", "decoded"])

    return code(text)


def _small_batches(df: DataFrame) -> None:
    """Texts may be long, so few of them go to Python at once."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ROWS_PER_BATCH)


def encode_documents(df: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``df`` plus ``ids``, ``n_tokens``. Columns of these names are replaced."""
    _small_batches(df)
    ids = with_results(df, ids=encode_column(F.col(f"`{text}`"), path))
    return ids.withColumn("n_tokens", F.size("ids").cast("long"))


def decode_documents(df: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """``df`` plus ``decoded``, the text of the ids."""
    _small_batches(df)
    return with_results(df, decoded=decode_column(F.col(f"`{ids}`"), path))


def code_documents(df: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``df`` plus ``ids``, ``n_tokens`` and ``decoded``: both directions at once. Columns of these names are replaced."""
    _small_batches(df)
    made = coded_column(F.col(f"`{text}`"), path)
    ids, decoded = made["ids"], made["decoded"]
    return with_results(df, ids=ids, n_tokens=F.size(ids).cast("long"), decoded=decoded)
