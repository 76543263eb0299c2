"""BPE encoding and decoding with a memory-mapped lexicon of frequent words.

The word counts of the whole corpus choose the frequent words.  Their token ids
are compiled once into a minimal acyclic transducer (:mod:`lexicon`), written to
the shared folder and memory-mapped by every task.  Words outside it are merged
exactly by the vocabulary's ranks, so the lexicon never changes a result.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
import uuid
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from . import lexicon
from .common import utf8_values, with_value, write_shared, written

LEXICON_WORDS = 200_000
LONGEST = 40
CACHE_WORDS = 300_000
CHUNK = 1 << 20
GATHER = 200_000
#: Bytes of texts, about, that are coded at a time where ids need not leave the task.
SLICE = 4 << 20
SIDE_BY_SIDE, ROUND_WORDS = 40, 4096
_NO_RANK = 1 << 40
#: Fixed pattern of the vocabulary's pre-tokenisation (after lower-casing); no
#: letter begins another alternative, so letters may stand first.
PIECE = regex.compile(r"[\p{L}]+|'s|'t|'re|'ve|'m|'ll|'d|[\p{N}]|[^\s\p{L}\p{N}]+")
#: The same where all characters are below U+0180.
_LETTERS, _DIGITS = "a-zA-Zªµº\xc0-\xd6\xd8-\xf6\xf8-\u017f", "0-9²³¹\xbc-\xbe"
LATIN_PIECE = re.compile(f"[{_LETTERS}]+|'(?:s|t|re|ve|m|ll|d)|[{_DIGITS}]|[^\\t-\\r \x85\xa0{_LETTERS}{_DIGITS}]+")
_BEYOND_LATIN = re.compile("[^\x00-\u017f]")
#: Blocks whose letters, digits and cases are the same in all Unicode versions since 6.0.
SETTLED = regex.compile(r"[^\x00-ԯ -⁯₠-₵℀-⅏←-⯿　-ヿ"
                        r"一-龥가-힣＀-￯\U0001F300-\U0001F64F]")
_SPACE = regex.compile(r"[ \t\n\r]")


def _byte_chars() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


BYTE_CHARS = _byte_chars()
_CHAR_BYTE = {c: b for b, c in enumerate(BYTE_CHARS)}


class Vocabulary:
    """Merge ranks and token texts of a word-end BPE vocabulary."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        ids, end = model["vocab"], model["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        texts = {i: t for t, i in [*ids.items(), *self.special.items()]}
        self.texts = [texts.get(i, "") for i in range(max(texts) + 1)]
        self.inner = np.array([ids[c] for c in BYTE_CHARS], np.uint32)
        self.last = np.array([ids[c + end] for c in BYTE_CHARS], np.uint32)
        self.merges = np.array([(ids[a], ids[b], ids[a + b]) for a, b in map(
            lambda m: m.split(" ") if isinstance(m, str) else m, model["merges"])], np.uint32).reshape(-1, 3)

    def sections(self) -> dict[str, np.ndarray]:
        blob = json.dumps({"texts": self.texts, "special": self.special}).encode()
        return {"inner": self.inner, "last": self.last, "merges": self.merges.ravel(), "texts": np.frombuffer(blob, np.uint8)}


class Merger:
    """Exact merges: of all adjacent pairs the lowest rank, the leftmost first."""

    def __init__(self, inner, last, merges):
        self.inner, self.last = np.asarray(inner, np.int64), np.asarray(last, np.int64)
        pairs = np.asarray(merges, np.int64).reshape(-1, 3)
        self.made = np.append(pairs[:, 2], -1)
        self.wide = int(pairs.max(initial=0)) + 1
        self.keys, self.ranks = self._table(pairs[:, 0] * self.wide + pairs[:, 1])

    def _table(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Open-addressing table from pair to rank; the first of equal pairs holds."""
        self.bits = max(8, int(np.ceil(np.log2(max(1, len(keys)) * 4))))
        table, ranks = np.full(1 << self.bits, -1, np.int64), np.full(1 << self.bits, _NO_RANK, np.int64)
        _, first = np.unique(keys, return_index=True)
        left = np.sort(first)
        self.probes = 0
        while len(left):
            slot = self._slot(keys[left], self.probes)
            free = table[slot] < 0
            _, one = np.unique(slot[free], return_index=True)
            put = left[free][one]
            table[slot[free][one]], ranks[slot[free][one]] = keys[put], put
            left = np.setdiff1d(left, put)
            self.probes += 1
        return table, ranks

    def _slot(self, keys: np.ndarray, probe: int) -> np.ndarray:
        mixed = (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)
        return (mixed.astype(np.int64) + probe) & ((1 << self.bits) - 1)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs, _NO_RANK where there is no merge or an id is -1."""
        keys = np.where((left >= 0) & (right >= 0), left * self.wide + right, -2)
        out = np.full(keys.shape, _NO_RANK, np.int64)
        for probe in range(self.probes):
            slot = self._slot(keys, probe)
            hit = self.keys[slot] == keys
            out = np.where(hit, self.ranks[slot], out)
        return out

    def ids(self, word: bytes) -> list[int]:
        return self.many([word])[0].tolist()

    def many(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of each word.  Words of like length are merged side by side: every
        round each takes its best merge."""
        out: list = [np.zeros(0, np.int64)] * len(words)
        order = sorted((i for i in range(len(words)) if words[i]), key=lambda i: len(words[i]))
        while order:
            size = len(words[order[-1]])
            if size > SIDE_BY_SIDE:
                i = order.pop()
                out[i] = self._long(words[i])
                continue
            part = order[:ROUND_WORDS]
            order = order[ROUND_WORDS:]
            for i, own in zip(part, self._round(np.array(part), words)):
                out[i] = own
        return out

    def _start(self, word: bytes) -> np.ndarray:
        parts = self.inner[np.frombuffer(word, np.uint8)]
        parts[-1] = self.last[word[-1]]
        return parts

    def _round(self, part: np.ndarray, words: list[bytes]) -> list[np.ndarray]:
        own = [words[i] for i in part]
        n, wide = len(own), len(own[-1])
        size = np.fromiter(map(len, own), np.int64, n)
        ids = np.full((n, wide + 1), -1, np.int64)
        inside = np.arange(wide + 1) < size[:, None]
        data = np.frombuffer(b"".join(own), np.uint8)
        ids[inside] = self.inner[data]
        ids[np.arange(n), size - 1] = self.last[data[np.cumsum(size) - 1]]
        ranks = self.rank(ids[:, :-1], ids[:, 1:])
        live, done = np.arange(n), np.full((n, wide + 1), -1, np.int64)
        columns = np.arange(wide + 1)
        while len(live):
            at = ranks.argmin(axis=1)
            best = ranks[np.arange(len(live)), at]
            go = best < _NO_RANK
            if not go.all():
                done[live[~go]] = ids[~go]
                live, ids, ranks, at, best = live[go], ids[go], ranks[go], at[go], best[go]
                if not len(live):
                    break
            rows = np.arange(len(live))
            shift = np.minimum(columns + (columns > at[:, None]), wide)
            ids = np.take_along_axis(ids, shift, axis=1)
            ids[:, -1] = -1
            ids[rows, at] = self.made[best]
            ranks = np.take_along_axis(ranks, np.minimum(shift[:, :-1], wide - 1), axis=1)
            ranks[:, -1] = _NO_RANK
            ranks[rows, at] = self.rank(ids[rows, at], ids[rows, at + 1])
            before = np.maximum(at - 1, 0)
            ranks[rows, before] = self.rank(ids[rows, before], ids[rows, before + 1])
        held = (done >= 0).sum(axis=1).tolist()
        return [done[i, :k] for i, k in enumerate(held)]

    def _long(self, word: bytes) -> np.ndarray:
        """The same order with a heap over a linked list."""
        parts = self._start(word)
        n = len(parts)
        first = self.rank(parts[:-1], parts[1:])
        parts = parts.tolist()
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        heap = [(r, i, parts[i], parts[i + 1]) for i, r in enumerate(first.tolist()) if r < _NO_RANK]
        heapq.heapify(heap)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if parts[i] != a or j < 0 or parts[j] != b:
                continue
            parts[i], parts[j] = int(self.made[rank]), -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            near = [x for x in (before[i], i) if x >= 0 and after[x] >= 0]
            found = self.rank(np.array([parts[x] for x in near]), np.array([parts[after[x]] for x in near])) if near else []
            for x, r in zip(near, found):
                if r < _NO_RANK:
                    heapq.heappush(heap, (int(r), x, parts[x], parts[after[x]]))
        return np.array([p for p in parts if p >= 0], np.int64)


def _chunks(text: str) -> Iterator[str]:
    """Pieces of a long text, cut before white space, where no word can go on."""
    at = 0
    while len(text) - at > CHUNK:
        found = _SPACE.search(text, at + CHUNK)
        if not found:
            break
        yield text[at:found.start()]
        at = found.start()
    yield text[at:] if at else text


def pieces(text: str, library: dict) -> list[str]:
    """The words of a text without special tokens, as the vocabulary splits them."""
    out: list[str] = []
    for part in _chunks(text):
        latin = part.isascii() or not _BEYOND_LATIN.search(part)
        if not latin and SETTLED.search(part):
            out += _pieces_by_library(part, library)
            continue
        if not latin:                     # below U+0180 nothing composes
            part = unicodedata.normalize("NFC", part)
            if "Σ" in part:               # the vocabulary lower-cases letter by letter
                part = "".join(c.lower() for c in part)
        part = part.lower()
        if latin and "\u0307" in part:    # the dot that a lower-cased capital dotted I leaves
            latin = False
        out += (LATIN_PIECE if latin else PIECE).findall(part)
    return out


def _pieces_by_library(text: str, library: dict) -> list[str]:
    """Letters outside the settled blocks: their classes depend on the Unicode
    version, so the tokenizer library's own normaliser and splitter decide."""
    if "split" not in library:
        from tokenizers import Regex, normalizers, pre_tokenizers
        library["norm"] = normalizers.Sequence([normalizers.NFC(), normalizers.Lowercase()])
        library["split"] = pre_tokenizers.Split(Regex(PIECE.pattern), "removed", invert=True)
    return [w for w, _ in library["split"].pre_tokenize_str(library["norm"].normalize_str(text))]


class Coder:
    """Encoder and decoder over one packed file, with a bounded cache of words."""

    def __init__(self, sections: dict[str, np.ndarray]):
        known = json.loads(bytes(sections["texts"]))
        self.special = known["special"]
        self.split = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.texts = pa.array(known["texts"], pa.string())
        self.merge = Merger(sections["inner"], sections["last"], sections["merges"])
        self.sections = sections
        self.cache: dict[str, bytes] = {}
        self.library: dict = {}

    def learn(self, words: set[str]) -> None:
        """Put the ids of ``words`` into the cache: by the lexicon, else by merging."""
        if len(self.cache) + len(words) > CACHE_WORDS:
            self.cache.clear()
        new = list(words)
        keys = [w.encode() for w in new]
        offsets, ids = self.sections.get("offsets"), self.sections.get("ids")
        numbers = lexicon.lookup(self.sections, keys) if offsets is not None else np.full(len(new), -1)
        unseen = [i for i, number in enumerate(numbers.tolist()) if number < 0]
        merged = self.merge.many([keys[i] for i in unseen])
        ends = np.cumsum([0, *map(len, merged)]) * 4
        blob = np.concatenate([np.zeros(0, np.int64), *merged]).astype("<u4").tobytes()
        for i, a, b in zip(unseen, ends.tolist(), ends[1:].tolist()):
            self.cache[new[i]] = blob[a:b]
        for word, number in zip(new, numbers.tolist()):
            if number >= 0:
                self.cache[word] = ids[offsets[number]:offsets[number + 1]].tobytes()

    def _coded(self, words: list[str]) -> bytes:
        try:
            return b"".join(map(self.cache.__getitem__, words))
        except KeyError:
            pass
        own = set(words)
        self.learn({w for w in own if w not in self.cache})
        if all(w in self.cache for w in own):
            return b"".join(map(self.cache.__getitem__, words))
        self.learn(own)                # the cache was emptied meanwhile, or holds less than one text needs
        return b"".join(self.cache[w] if w in self.cache else np.array(self.merge.ids(w.encode()), "<u4").tobytes() for w in words)

    def _parts(self, text: str) -> list:
        """The words of a text, special tokens as their ids."""
        if self.split is None or "<|" not in text:
            return [pieces(text, self.library)]
        return [self.special[p] if p in self.special else pieces(p, self.library) for p in self.split.split(text) if p]

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian 32-bit numbers."""
        return self._joined(self._parts(text))

    def _joined(self, parts: list) -> bytes:
        return b"".join(np.array([p], "<u4").tobytes() if isinstance(p, int) else self._coded(p) for p in parts)

    def encode_batch(self, texts: list[bytes | None]) -> pa.ListArray:
        coded: list[bytes] = []
        waiting: list[list] = []
        n = 0
        for i, t in enumerate(texts):
            parts = self._parts((t or b"").decode())
            waiting.append(parts)
            n += sum(len(p) for p in parts if isinstance(p, list))
            if n > GATHER or i == len(texts) - 1:     # new words of many texts are looked up together
                words = set().union(*(p for parts in waiting for p in parts if isinstance(p, list)))
                self.learn({w for w in words if w not in self.cache})
                coded += map(self._joined, waiting)
                waiting, n = [], 0
        ends = np.cumsum([0, *(len(c) // 4 for c in coded)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(coded), "<u4").astype(np.int32)))

    def decode_batch(self, ids: pa.ListArray) -> pa.Array:
        """Token texts joined by spaces: this vocabulary has no other decoder."""
        flat = ids.flatten()
        sizes = pc.list_value_length(ids).fill_null(0)
        ends = np.concatenate([[0], np.cumsum(np.asarray(sizes))]).astype(np.int32)
        listed = pa.ListArray.from_arrays(pa.array(ends), self.texts.take(flat))
        return pc.binary_join(listed, " ")


_CODERS: dict[str, Coder] = {}


def _coder(name: str) -> Coder:
    """This worker's coder over the file ``name`` that Spark brought to the machine."""
    if name not in _CODERS:
        _CODERS.clear()
        _CODERS[name] = Coder(lexicon.mapped(SparkFiles.get(name)))
    return _CODERS[name]


def frequent_words(docs: DataFrame, text: str = "text", most: int = LEXICON_WORDS) -> DataFrame:
    """``(word, n)``: the most frequent words of all texts, at most ``most``, of up
    to LONGEST bytes and more than one occurrence; counted over the whole corpus."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        library: dict = {}

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])
            counts.clear()
            return out

        for batch in batches:
            for data in utf8_values(batch.column(0)):
                if data:
                    counts.update(pieces(data.decode(), library))
                if len(counts) > CACHE_WORDS:
                    yield flush()
        yield flush()

    words = docs.select(F.col(text).alias("text")).mapInArrow(run, "word string, n long")
    words = words.groupBy("word").agg(F.sum("n").alias("n")).filter((F.octet_length("word") <= LONGEST) & (F.col("n") > 1))
    words = written(words, "word-counts")
    # the frequency from which on at most ``most`` words are left, by steps of a 16th of a doubling
    step = F.floor(F.log2("n") * 16)
    room, least = most, 0
    for r in sorted(words.groupBy(step.alias("step")).agg(F.count("*").alias("k")).collect(), key=lambda r: -r.step):
        room -= r.k
        if room < 0:
            least = r.step + 1
            break
    return words.filter(step >= least)


def compile_lexicon(spark: SparkSession, vocabulary: str, words: list[str]) -> str:
    """Write the packed file of the vocabulary and the ids of ``words`` to the
    shared folder, hand it to Spark's file distribution, and return its name."""
    vocab = Vocabulary(vocabulary)
    merge = Merger(vocab.inner, vocab.last, vocab.merges)
    keys = sorted({w.encode() for w in words if w})
    ids = merge.many(keys)
    offsets = np.cumsum([0, *map(len, ids)]).astype(np.uint32)
    sections = vocab.sections() | lexicon.minimal_automaton(keys) | {
        "offsets": offsets, "ids": np.concatenate([np.zeros(0, np.int64), *ids]).astype("<u4")}
    name = f"lexicon-{uuid.uuid4().hex}.bin"
    spark.sparkContext.addFile(write_shared(spark, name, lexicon.pack(sections)))
    return name


def lexicon_of(docs: DataFrame, vocabulary: str, text: str = "text", most: int = LEXICON_WORDS) -> str:
    """Lexicon file of the frequent words of ``docs``; at most ``most`` words of
    at most LONGEST bytes reach the driver."""
    return compile_lexicon(docs.sparkSession, vocabulary, [r.word for r in frequent_words(docs, text, most).collect()])


def encode(docs: DataFrame, lexicon_file: str, text: str = "text", out: str = "ids", drop_text: bool = False) -> DataFrame:
    """``docs`` with the token ids of ``text`` in ``out`` (array<int>).

    Null and empty texts have no ids.  Texts of any length are coded whole, in
    pieces cut at white space.  Strings of special tokens in a text are those
    tokens, as the library has it.
    """
    return with_value(docs, text, lambda texts: _coder(lexicon_file).encode_batch(texts), out, ArrayType(IntegerType()), drop_text)


def decode(coded: DataFrame, lexicon_file: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``coded`` with the text of ``ids`` in ``out``; null ids give the empty text."""
    keep = [f for f in coded.schema.fields if f.name != out]
    names = [f.name for f in keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = _coder(lexicon_file).decode_batch(batch.column(ids))
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), texts], [*names, out])

    schema = coded.select(*names).schema.add(out, StringType())
    return coded.select(*names).mapInArrow(run, schema)


def _slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of rows that hold SLICE bytes, or a single longer text."""
    sizes = pc.fill_null(pc.binary_length(texts), 0)
    begin, held = 0, 0
    for i, size in enumerate(sizes.to_pylist()):
        if held and held + size > SLICE:
            yield begin, i
            begin, held = i, 0
        held += size
    if begin < len(texts):
        yield begin, len(texts)


def with_coded(docs: DataFrame, lexicon_file: str, values: Callable[[pa.ListArray, pa.Array], list[pa.Array]],
               fields: list[StructField], text: str = "text") -> DataFrame:
    """``docs`` without ``text`` and with the columns ``fields`` = ``values(ids, decoded texts)``.

    :func:`encode` and :func:`decode` in one pass: a task needs one Python worker, and
    ids and texts stay in it, a slice of a batch at a time, unless ``values`` hands
    them on.  ``fields`` replace columns of their names; nulls and long texts as in :func:`encode`.
    """
    made = {f.name for f in fields}
    keep = [f for f in docs.schema.fields if f.name != text and f.name not in made]
    names = [f.name for f in keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(lexicon_file)
        for batch in batches:
            for a, b in _slices(batch.column(text)):
                part = batch.slice(a, b - a)
                ids = coder.encode_batch(utf8_values(part.column(text)))
                yield pa.RecordBatch.from_arrays([*(part.column(n) for n in names), *values(ids, coder.decode_batch(ids))],
                                                 [*names, *(f.name for f in fields)])

    picked = docs.select(*[F.col(f"`{c}`") for c in [*names, text]])
    return picked.mapInArrow(run, StructType([*keep, *fields]))
