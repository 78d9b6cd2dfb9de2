"""Token counts (operator 6) and token files (operator 5) with a byte-level BPE vocabulary.

A block of texts is cut in its UTF-8 bytes, only where the vocabulary's pattern starts a new pre-token whatever stands
around, so the cuts don't change the result. Arrow finds the different parts of a block and puts the texts together again
from the parts' values; only new parts go to the library, most of them single pre-tokens. Each Python worker keeps its last
``MEMO_WORDS`` parts and ``MEMO_PIECES`` pre-tokens of parts that hold several, and the parts of the block in hand.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from itertools import chain, filterfalse, pairwise

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.ipc
import regex
from pyspark import TaskContext
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

from tideline.llm.registry import query, table
from tideline.session import scratch

MEMO_WORDS = 5 << 18
MEMO_PIECES = 3 << 18
SEQUENCE_TOKENS = 1024
BATCH_SEQUENCES = 64
END_ID = 2
BLOCK_BYTES = 4 << 20


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    return public_tokenizers.path(name)


class Memo:
    """Values of strings in two generations: when the young one is full, it becomes the old one, whose values come back
    when they are asked for again. ``seeds`` are kept for good."""

    def __init__(self, limit: int, seeds: dict[str, object] | None = None):
        self.half, self.seeds = max(1, limit // 2), seeds or {}
        self.young, self.old = {}, {}

    def turn(self) -> dict:
        """The young generation, to be asked at the start of a batch: what is learnt then stays until the next turn."""
        if len(self.young) > self.half:
            self.old, self.young = self.young, {}
        return self.young

    def learn(self, strings: Iterable[str], encode: Callable[[list[str]], list]) -> None:
        young, old, seeds, new = self.young, self.old, self.seeds, []
        for s in strings:
            value = old.get(s)
            if value is None:
                value = seeds.get(s)
            if value is None:
                new.append(s)
            else:
                young[s] = value
        for at in range(0, len(new), 8192):
            part = new[at : at + 8192]
            young.update(zip(part, encode(part), strict=True))


# Kinds of bytes: not known (parts of other characters, control characters), letters, digits, other printable ASCII, the
# apostrophe, which may begin a pre-token with letters, the space, other ASCII white space, and first bytes of characters
# that are not ASCII and no white space.
_UNKNOWN, _LETTER, _DIGIT, _OTHER, _APOSTROPHE, _SPACE, _BREAK, _SOLID = range(8)


def _kinds() -> np.ndarray:
    kinds = np.full(256, _UNKNOWN, dtype=np.uint8)
    kinds[0x21:0x7F] = _OTHER
    kinds[[*range(65, 91), *range(97, 123)]] = _LETTER
    kinds[48:58] = _DIGIT
    kinds[[0x27, 0x20]] = _APOSTROPHE, _SPACE
    kinds[0x09:0x0E] = _BREAK
    # White space and marks without width begin with C2, E1, E2, E3 or EF; see _solid.
    kinds[[b for b in range(0xC3, 0xF5) if b not in (0xE1, 0xE2, 0xE3, 0xEF)]] = _SOLID
    return kinds


def _cut_before_second() -> np.ndarray:
    """By the kinds of two neighbours, 8 * first + second: whether a pre-token always starts at the second one."""
    cut, solid = np.zeros((8, 8), dtype=bool), [_LETTER, _DIGIT, _OTHER, _APOSTROPHE]
    for first in (_LETTER, _DIGIT, _OTHER):
        cut[first, solid] = True
        cut[first, first] = False
    cut[_OTHER, _APOSTROPHE] = False
    cut[np.ix_(solid, [_SPACE, _BREAK])] = True
    cut[_BREAK, [*solid, _SOLID]] = True
    return cut.ravel()


def _cut_before_first() -> np.ndarray:
    """The same at the first one: the last white space before another character stands alone, or begins it as a space."""
    cut = np.zeros((8, 8), dtype=bool)
    cut[np.ix_([_SPACE, _BREAK], [_LETTER, _DIGIT, _OTHER, _APOSTROPHE, _SOLID])] = True
    return cut.ravel()


_KIND, _AT_SECOND, _AT_FIRST = _kinds(), _cut_before_second(), _cut_before_first()


def _solid(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the characters beginning at ``at`` with C2, E1, E2 or E3 are certainly no white space."""
    first, second, third = data[at], data[at + 1], data[np.minimum(at + 2, len(data) - 1)]
    general = np.where(second == 0x80, ((third >= 0x90) & (third <= 0xA7)) | (third >= 0xB0), (second != 0x81) | (third < 0x9F))
    return np.select(
        [first == 0xC2, first == 0xE1, first == 0xE2, first == 0xE3],
        [second > 0xA0, (second != 0x9A) & (second != 0xA0), general, (second != 0x80) | (third != 0x80)],
        False,
    )


def cut_texts(data: np.ndarray, ends: np.ndarray, specials: Iterable[bytes] = ()) -> np.ndarray:
    """Places where the parts of texts begin. ``data`` holds the texts' UTF-8 bytes one after another, ``ends`` where each
    begins, and the end. A text with a special string is one part, since the library finds that string first."""
    cut = np.zeros(len(data), dtype=bool)
    if not len(data):
        return np.flatnonzero(cut)
    kinds = _KIND[data]
    spaced = np.flatnonzero((kinds[1:] == _UNKNOWN) & (data[1:] >= 0xC2) & ((kinds[:-1] == _SPACE) | (kinds[:-1] == _BREAK))) + 1
    kinds[spaced[_solid(data, spaced)]] = _SOLID
    pairs = (kinds[:-1] << 3) | kinds[1:]
    begins = ends[ends < len(data)]
    cut[:-1] = _AT_FIRST[pairs]
    cut[begins[begins > 0] - 1] = False
    cut[1:] |= _AT_SECOND[pairs]
    for special in specials:
        whole, at = data.tobytes(), -1
        while (at := whole.find(special, at + 1)) >= 0:
            text = np.searchsorted(ends, at, side="right") - 1
            cut[ends[text] : ends[text + 1]] = False
            at = int(ends[text + 1]) - 1
    cut[begins] = True
    return np.flatnonzero(cut)


class Words:
    """Values of texts put together from values of their parts; ``encode`` gives the values of new parts."""

    def __init__(self, encode: Pieces, known: dict[str, object], limit: int = MEMO_WORDS):
        self.encode, self.memo = encode, Memo(limit, known)

    def parts(self, texts: pa.Array) -> tuple[list, np.ndarray, np.ndarray]:
        """Values of the different parts of texts (no nulls), the number of each part's value in the order of the texts,
        and the place of each text's first part, with the end."""
        texts = texts.cast(pa.large_string())
        _, places, held = texts.buffers()
        ends = np.frombuffer(places, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
        data = np.frombuffer(held, dtype=np.uint8)[ends[0] : ends[-1]] if held is not None else np.empty(0, np.uint8)
        ends = ends - ends[0]
        begins = cut_texts(data, ends, self.encode.specials)
        bounds = np.append(begins, len(data))
        cut = pa.LargeStringArray.from_buffers(len(begins), pa.py_buffer(bounds), pa.py_buffer(data)).dictionary_encode()
        parts = cut.dictionary.to_numpy(zero_copy_only=False).tolist()
        known = self.memo.turn()
        values = [*map(known.get, parts)]
        if None in values:
            self.memo.learn([p for p, v in zip(parts, values, strict=True) if v is None], self.encode)
            values = [known[p] if v is None else v for p, v in zip(parts, values, strict=True)]
        return values, cut.indices.to_numpy(), np.searchsorted(begins, ends)

    def values(self, texts: list[str]) -> Iterator[list]:
        """For each text the values of its parts, in order."""
        values, numbers, firsts = self.parts(pa.array(texts, pa.large_string()))
        for start, end in pairwise(firsts.tolist()):
            yield [values[n] for n in numbers[start:end].tolist()]


def text_blocks(texts: pa.Array, most_bytes: int = BLOCK_BYTES) -> Iterator[pa.Array]:
    """Slices of at most ``most_bytes`` bytes, or one text."""
    sizes, at = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64), 0
    while at < len(texts):
        before = int(sizes[at - 1]) if at else 0
        end = max(at + 1, int(np.searchsorted(sizes, before + most_bytes, side="right")))
        yield texts.slice(at, end - at)
        at = end


@lru_cache(maxsize=2)
def _tokenizer(path: str) -> Tokenizer:
    return Tokenizer.from_file(path)


def byte_letters() -> dict[int, int]:
    """The letter that stands for each byte in a byte-level vocabulary: fixed values of the format. Printable Latin-1
    characters other than the space and the soft hyphen stand for themselves, the other bytes for those from 256 on."""
    other = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 255) or b == 173]
    return {b: 256 + k for k, b in enumerate(other)}


class Pieces:
    """Values of words from those of their pre-tokens, which the library's model merges one by one; new ones only."""

    def __init__(self, path: str, value: Callable[[list[int]], object], total: Callable[[list], object], limit: int = MEMO_PIECES):
        self.tokenizer, self.value, self.total, self.memo = _tokenizer(path), value, total, Memo(limit)
        pattern = public_tokenizers.PATTERN
        self.find = regex.compile(pattern).findall
        # The same pattern over printable ASCII, where the quicker engine has all of its classes.
        self.find_plain = re.compile(pattern.replace(r"\s\p{L}\p{N}", r"\sA-Za-z0-9").replace(r"\p{L}", "[A-Za-z]").replace(r"\p{N}", "[0-9]")).findall
        specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.specials = [s.encode() for s in specials]
        self.special = re.compile("|".join(map(re.escape, specials)) or r"(?!)").search
        if self.tokenizer.normalizer is not None or not isinstance(self.tokenizer.pre_tokenizer, ByteLevel):
            raise ValueError(f"{path}: not a byte-level vocabulary without a normalizer")

    def merge(self, words: list[str]) -> list:
        """Values of whole words, special strings and all."""
        return [self.value(e.ids) for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def merge_pieces(self, pieces: list[str]) -> list:
        letters, merge, value, space = byte_letters(), self.tokenizer.model.tokenize, self.value, chr(byte_letters()[32])
        plain = (
            p.replace(" ", space) if p.isascii() and p.isprintable() else p.encode().decode("latin-1").translate(letters) for p in pieces
        )
        return [value([token.id for token in merge(p)]) for p in plain]

    def __call__(self, words: list[str]) -> list:
        # A word of ASCII letters, with or without a space before it, is a pre-token.
        values = [None] * len(words)
        single = [n for n, w in enumerate(words) if w.isascii() and (w.isalpha() or (w[:1] == " " and w[1:].isalpha()))]
        for n, value in zip(single, self.merge_pieces([words[n] for n in single]), strict=True):
            values[n] = value
        if len(single) < len(words):
            rest = [n for n, v in enumerate(values) if v is None]
            for n, value in zip(rest, self.merge_split([words[n] for n in rest]), strict=True):
                values[n] = value
        return values

    def merge_split(self, words: list[str]) -> list:
        known, find, plain, special, total = self.memo.turn(), self.find, self.find_plain, self.special, self.total
        # Special strings are found by the library before it looks for pre-tokens: such words are its own. So are those in
        # which letters of a newer Unicode than the library's might stand before an apostrophe.
        split = [
            None if special(w) else plain(w) if w.isascii() and w.isprintable() else None if "'" in w and not w.isascii() else find(w) for w in words
        ]
        self.memo.learn(set(filterfalse(known.__contains__, chain.from_iterable(filter(None, split)))), self.merge_pieces)
        own = iter(self.merge([w for w, parts in zip(words, split, strict=True) if parts is None]))
        return [next(own) if ps is None else known[ps[0]] if len(ps) == 1 else total([known[p] for p in ps]) for ps in split]


# --- operator 6: counts ------------------------------------------------------------------------------------------


def single_token_strings(path: str) -> list[str]:
    """Vocabulary strings that the library encodes alone as one token, which is that string's own: tried one by one."""
    tokenizer = _tokenizer(path)
    ids = list(tokenizer.get_vocab().values())
    # A string that decodes with a replacement character is part of a character; no text holds it alone.
    strings = [s for s in tokenizer.decode_batch([[i] for i in ids], skip_special_tokens=False) if "�" not in s]
    found = tokenizer.encode_batch_fast(strings, add_special_tokens=False)
    return sorted({s for s, e in zip(strings, found, strict=True) if s and len(e.ids) == 1})


class PieceCounter(Pieces):
    """Token counts of words: pre-tokens that are proven single tokens count 1, only the rest is merged."""

    def __init__(self, path: str, singles: frozenset[str], limit: int = MEMO_PIECES):
        super().__init__(path, len, sum, limit)
        self.memo.seeds = dict.fromkeys(singles, 1)


_COUNTERS: dict[str, Words] = {}


def _counter(path: str, singles: Broadcast) -> Words:
    """One for each worker, so that words stay known from task to task."""
    if path not in _COUNTERS:
        _COUNTERS[path] = Words(PieceCounter(path, frozenset(singles.value)), dict.fromkeys(singles.value, 1))
    return _COUNTERS[path]


def counts(words: Words, texts: pa.Array) -> np.ndarray:
    """Tokens of each text."""
    values, numbers, firsts = words.parts(texts)
    before = np.append(0, np.cumsum(np.array(values, dtype=np.int64)[numbers]))
    return np.diff(before[firsts])


def count_tokens(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """Adds n_bytes and n_tokens of the whole text (null: empty, 0 tokens); other columns and repeated rows stay.

    Existing columns named n_bytes or n_tokens are replaced. The proven strings are at most the vocabulary's, so their
    broadcast is bounded by it.
    """
    singles = docs.sparkSession.sparkContext.broadcast(single_token_strings(path))

    @F.pandas_udf("long")
    def n_tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        words = _counter(path, singles)
        for batch in batches:
            yield pd.Series(np.concatenate([np.empty(0, np.int64), *(counts(words, block) for block in text_blocks(pa.array(batch, pa.large_string())))]))

    whole = F.coalesce(F.col(text), F.lit(""))
    return docs.withColumns({"n_bytes": F.octet_length(whole).cast("bigint"), "n_tokens": n_tokens(whole)})


@query("op6_token_counts")
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = count_tokens(docs, vocabulary_path())
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 512).alias("over_limit"))


# --- operator 5: files -------------------------------------------------------------------------------------------


@lru_cache(maxsize=2)
def _encoder(path: str) -> tuple[Words, np.dtype]:
    kind = id_type(path)
    code = "H" if kind.itemsize == 2 else "I"
    return Words(Pieces(path, lambda ids: array(code, ids).tobytes(), b"".join), {}), kind


def id_type(path: str) -> np.dtype:
    """The narrowest little-endian unsigned integers that hold every id."""
    return np.dtype("<u2" if _tokenizer(path).get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4")


def sequence_schema(kind: np.dtype, length: int) -> pa.Schema:
    fields = [("tokens", pa.list_(pa.from_numpy_dtype(kind), length)), ("mask", pa.list_(pa.bool_(), length))]
    return pa.schema([pa.field(n, t, nullable=False) for n, t in fields])


def ended_ids(words: Words, kind: np.dtype, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of texts one after another, ``end_id`` after each, and how many each text has with it."""
    values, numbers, firsts = words.parts(texts)
    taken = pa.array(values, pa.large_binary()).take(pa.array(numbers))
    _, places, held = taken.buffers()
    before = np.frombuffer(places, dtype=np.int64)[: len(taken) + 1] // kind.itemsize if len(taken) else np.zeros(1, np.int64)
    ids = np.frombuffer(held, dtype=kind)[: before[-1]] if before[-1] else np.empty(0, kind)
    ends = before[firsts]
    return np.insert(ids, ends[1:], end_id), np.diff(ends) + 1


class SequenceWriter:
    """Ids in, an Arrow stream-file out: rows of ``length`` ids with a mask, which is false in the padding of the last row."""

    def __init__(self, sink, kind: np.dtype, length: int = SEQUENCE_TOKENS, rows: int = BATCH_SEQUENCES):
        self.kind, self.length, self.rows = kind, length, rows
        self.schema = sequence_schema(kind, length)
        self.writer = pa.ipc.new_file(sink, self.schema)
        self.held: list[np.ndarray] = []
        self.n_held = 0

    def add(self, ids: np.ndarray) -> None:
        self.held.append(ids)
        self.n_held += len(ids)
        if self.n_held >= self.length * self.rows:
            flat, size = np.concatenate(self.held), self.length * self.rows
            for at in range(0, len(flat) - size + 1, size):
                self._write(flat[at : at + size], size)
            self.held = [flat[len(flat) - len(flat) % size :].copy()]
            self.n_held = len(self.held[0])

    def _write(self, flat: np.ndarray, used: int) -> None:
        mask = np.zeros(len(flat), dtype=bool)
        mask[:used] = True
        columns = [pa.FixedSizeListArray.from_arrays(pa.array(x), type=t) for x, t in zip((flat, mask), self.schema.types, strict=True)]
        self.writer.write_batch(pa.record_batch(columns, schema=self.schema))

    def close(self) -> None:
        if self.n_held:
            flat = np.zeros(-(-self.n_held // self.length) * self.length, dtype=self.kind)
            flat[: self.n_held] = np.concatenate(self.held)
            self._write(flat, self.n_held)
        self.writer.close()


class SequenceReader:
    """Random access to a file of SequenceWriter: every full batch holds as many ids, so a place is found by division."""

    def __init__(self, source):
        self.file = pa.ipc.open_file(source)
        self.batch_ids = 0
        if self.file.num_record_batches:
            first = self.file.get_batch(0)
            self.batch_ids = first.num_rows * first.schema.field("tokens").type.list_size
        self.at, self.flat, self.mask = -1, None, None

    def read(self, start: int, n: int) -> np.ndarray:
        parts = []
        while n > 0:
            k, at = divmod(start, self.batch_ids)
            if k != self.at:
                batch = self.file.get_batch(k)
                self.at = k
                self.flat = batch.column(0).flatten().to_numpy(zero_copy_only=True)
                self.mask = batch.column(1).flatten().to_numpy(zero_copy_only=False)
            part = self.flat[at : at + n]
            if not len(part) or not self.mask[at : at + len(part)].all():
                raise ValueError(f"no {n} ids from {start} on")
            parts.append(part)
            start, n = start + len(part), n - len(part)
        return parts[0] if len(parts) == 1 else np.concatenate([np.empty(0, dtype="<u2"), *parts])


def _file(folder: str, shard: int) -> tuple[pafs.FileSystem, str]:
    # Hadoop writes file:/path and s3a://, Arrow file:///path and s3://.
    uri = re.sub("^s3[an]://", "s3://", folder) if "://" in folder else "file://" + folder.removeprefix("file:")
    store, path = pafs.FileSystem.from_uri(uri)
    return store, f"{path}/shard-{shard:06d}.arrow"


def write_sequences(docs: DataFrame, folder: str, path: str, end_id: int = END_ID, length: int = SEQUENCE_TOKENS) -> DataFrame:
    """Encodes whole texts, ends each with ``end_id`` and writes them to ``folder`` in ascending doc_id order.

    One Arrow file per range of doc_ids, written by its task under another name and then moved, so a repeated task
    puts the same file in place. Returns the index, which is a table in ``folder``: doc_id, shard, local_start,
    n_tokens. Null texts are empty and have one id; null doc_ids come first; rows with the same doc_id go by text.
    Other columns are left out. No rows: no ids, and an empty index.
    """
    spark = docs.sparkSession
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).repartitionByRange(shards, "doc_id").sortWithinPartitions("doc_id", "text")
    files = f"{folder}/files"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, kind = _encoder(path)
        context = TaskContext.get()
        shard = context.partitionId()
        store, name = _file(files, shard)
        store.create_dir(name.rpartition("/")[0], recursive=True)
        part, start = f"{name}.{context.taskAttemptId()}", 0
        with store.open_output_stream(part) as sink:
            writer = SequenceWriter(sink, kind, length)
            for batch in batches:
                sizes = [np.empty(0, np.int64)]
                for block in text_blocks(batch.column(1)):
                    ids, n = ended_ids(words, kind, block, end_id)
                    writer.add(ids)
                    sizes.append(n)
                n = np.concatenate(sizes)
                ends = start + np.cumsum(n)
                columns = [batch.column(0).cast(pa.int64()), *map(pa.array, (np.full(len(n), shard), ends - n, n))]
                start = int(ends[-1]) if len(n) else start
                yield pa.record_batch(columns, ["doc_id", "shard", "local_start", "n_tokens"])
            writer.close()
        store.move(part, name)

    ordered.mapInArrow(write, "doc_id bigint, shard bigint, local_start bigint, n_tokens bigint").write.parquet(f"{folder}/index")
    return spark.read.parquet(f"{folder}/index")


def global_starts(index: DataFrame, block: int = 1024) -> DataFrame:
    """Adds ``start``: the ids of all documents before. Prefix sums over shards go in two levels, blocks of shards first."""
    totals = index.groupBy("shard").agg(F.sum("n_tokens").alias("total")).withColumn("block", F.floor(F.col("shard") / block))
    inside = Window.partitionBy("block").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    outside = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = totals.groupBy("block").agg(F.sum("total").alias("block_total")).select("block", F.coalesce(F.sum("block_total").over(outside), F.lit(0)).alias("before"))
    shards = totals.withColumn("in_block", F.coalesce(F.sum("total").over(inside), F.lit(0))).join(blocks, "block")
    starts = shards.select("shard", (F.col("before") + F.col("in_block")).alias("shard_start"))
    return index.join(starts, "shard").withColumn("start", F.col("shard_start") + F.col("local_start")).drop("shard_start")


def read_sequences(index: DataFrame, folder: str) -> DataFrame:
    """Reads each document's ids back from the files by its place; adds ids_crc32 of them as unsigned 32-bit integers."""
    files = f"{folder}/files"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, opened = None, None
        for batch in batches:
            found = []
            for shard, start, n in zip(*(batch.column(c).to_pylist() for c in ("shard", "local_start", "n_tokens")), strict=True):
                if shard != opened:
                    store, name = _file(files, shard)
                    local = isinstance(store, pafs.LocalFileSystem)
                    reader, opened = SequenceReader(pa.memory_map(name) if local else store.open_input_file(name)), shard
                found.append(zlib.crc32(reader.read(start, n).astype("<u4").tobytes()))
            yield pa.record_batch([*(batch.column(c) for c in ("doc_id", "start", "n_tokens")), pa.array(found, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return index.select("doc_id", "shard", "local_start", "n_tokens", "start").mapInArrow(
        read, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    )


@query("op5_token_files")
def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch(spark, "tokens")
    index = write_sequences(table(spark, sf_dir, "documents"), folder, vocabulary_path())
    return read_sequences(global_starts(index), folder)
