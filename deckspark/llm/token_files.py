"""Operator 1: token ids as Arrow stream files of equal-length sequences.

Documents, in ascending ``doc_id`` order, become one stream of token ids with
an end id after each document.  Every shard file is an Arrow *stream* file
whose record batches all hold ``rows_per_batch`` rows (the last may hold
fewer) of three fixed-size lists of ``seq_len`` items:

``input_ids``       uint16 (uint32 for vocabularies over 65,536)
``attention_mask``  bits, 1 for an id and 0 for padding at the shard's end
``document_end``    bits, 1 at the end id of each document

Fixed sizes make row ``i`` of a memory-mapped file reachable by arithmetic
alone, without a copy (:func:`open_sequences`, :func:`sequence`).  The mask of document ends is
needed because the end id may also be an ordinary id.  A companion stream
file holds (doc_id, start, n_tokens) per document, ``start`` counted from the
shard's first id; the manifest table has one row per shard with its place in
the whole stream.

Defined results: a null text is an empty text (its end id alone); a null
``doc_id`` sorts first; rows with equal ``doc_id`` are ordered by a hash of
the text and each keeps its own entry; an empty table gives no shard; other
columns are ignored.
"""

from __future__ import annotations

import functools
import itertools
import math
import zlib
from bisect import bisect_right

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .storage import cut_lineage, file_system, held, own_file, shared_folder
from .words import MEMO, SPECIAL, Disputed, disputed_characters, has_wide_space, pieces

SEQ_LEN = 2048
ROWS_PER_BATCH = 64
SLICE = 4 << 20  # bytes of text encoded at once, about
SAMPLE = 40  # rows sampled for a shard's bounds
MOST_SAMPLED = 200_000  # rows of three numbers that come to the driver
SHARD_DOCS = 50_000  # documents of a shard, at most about
SHARD_ROWS = "shard long, first_doc long, path string, index_path string, n_docs long, n_sequences long, n_tokens long"


def _id_type(vocab_size: int):
    return pa.uint16() if vocab_size <= 1 << 16 else pa.uint32()


def _stream_schema(seq_len: int, id_type) -> pa.Schema:
    return pa.schema(
        [
            pa.field("input_ids", pa.list_(id_type, seq_len)),
            pa.field("attention_mask", pa.list_(pa.bool_(), seq_len)),
            pa.field("document_end", pa.list_(pa.bool_(), seq_len)),
        ]
    )


_INDEX = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])


class _ShardWriter:
    """Appends documents' ids to one shard; holds one record batch."""

    def __init__(self, folder: str, seq_len: int, rows: int, id_type):
        self.seq_len, self.width = seq_len, seq_len * rows
        self.schema, self.dtype = _stream_schema(seq_len, id_type), id_type.to_pandas_dtype()
        fs, path, self.path = own_file(folder, ".arrow")
        self.sink = fs.open_output_stream(path)
        self.out = pa.ipc.new_stream(self.sink, self.schema)
        fs, path, self.index_path = own_file(folder, ".index.arrow")
        self.index_sink = fs.open_output_stream(path)
        self.index = pa.ipc.new_stream(self.index_sink, _INDEX)
        self.ids, self.ends = np.zeros(self.width, self.dtype), np.zeros(self.width, bool)
        self.fill = self.total = self.sequences = self.docs = 0
        self.entries: list[tuple] = []

    def add(self, doc_id, ids: np.ndarray) -> None:
        self.entries.append((doc_id, self.total, len(ids)))
        self.docs += 1
        if len(self.entries) == 10_000:
            self._flush_index()
        at = 0
        while at < len(ids):
            n = min(len(ids) - at, self.width - self.fill)
            self.ids[self.fill : self.fill + n] = ids[at : at + n]
            at += n
            self.fill += n
            if at == len(ids):
                self.ends[self.fill - 1] = 1
            if self.fill == self.width:
                self._flush()
        self.total += len(ids)

    def _flush(self) -> None:
        rows = -(-self.fill // self.seq_len)
        n = rows * self.seq_len
        mask = np.zeros(n, bool)
        mask[: self.fill] = 1
        self.ids[self.fill : n] = 0
        fixed = lambda x, f: pa.FixedSizeListArray.from_arrays(pa.array(x[:n].copy()), type=f.type)
        cols = [fixed(x, f) for x, f in zip((self.ids, mask, self.ends), self.schema)]
        self.out.write_batch(pa.RecordBatch.from_arrays(cols, schema=self.schema))
        self.sequences += rows
        self.fill = 0
        self.ends[:] = 0

    def _flush_index(self) -> None:
        if self.entries:
            cols = [pa.array(c, pa.int64()) for c in zip(*self.entries)]
            self.index.write_batch(pa.RecordBatch.from_arrays(cols, schema=_INDEX))
            self.entries = []

    def close(self) -> None:
        if self.fill:
            self._flush()
        self._flush_index()
        for x in (self.out, self.sink, self.index, self.index_sink):
            x.close()


class _PieceIds:
    """Numbers pieces of text and keeps their ids by number: those of piece
    ``i`` are ``ids[ends[i]:ends[i + 1]]``.  ``encode`` gives the ids of a
    list of pieces in one array, and the place after each piece's last.
    Everything is forgotten when ``limit`` pieces are exceeded."""

    def __init__(self, encode, dtype, limit: int = MEMO):
        self.encode, self.limit = encode, limit
        self.nothing = np.zeros(0, dtype)
        self._forget()

    def _forget(self) -> None:
        self.number: dict[str, int] = {}
        self.ids, self.ends = self.nothing, np.zeros(1, np.int64)

    def numbers(self, distinct: list[str]) -> np.ndarray:
        def known() -> np.ndarray:
            return np.fromiter(map(self.number.get, distinct, itertools.repeat(-1)), np.int64, len(distinct))

        found = known()
        if len(self.number) + np.count_nonzero(found < 0) > self.limit:
            self._forget()
            found = known()
        holes = np.flatnonzero(found < 0)
        if len(holes):
            new, first = [distinct[i] for i in holes.tolist()], len(self.number)
            ids, ends = self.encode(new)
            found[holes] = np.arange(first, first + len(new))
            self.number.update(zip(new, range(first, first + len(new))))
            self.ids = np.concatenate([self.ids, ids])
            self.ends = np.concatenate([self.ends, self.ends[-1] + ends])
        return found


@functools.lru_cache(maxsize=2)
def library_encoder(tokenizer_path: str, dtype, disputed: str):
    """Kept per worker.  A function texts -> list of id arrays, by the
    tokenizers library.  Pieces repeat: Arrow finds the distinct ones of the
    texts, these are looked up once each, new ones are encoded as one text
    whose ids are cut by the bytes they stand for.  Texts with a special
    string or a disputed character are encoded whole."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer_path)
    tok.no_truncation()
    tok.no_padding()
    vocab = tok.get_vocab()
    n_bytes = np.zeros(max(vocab.values()) + 1, np.int64)
    for token, i in vocab.items():  # byte-level: a character is a byte
        n_bytes[i] = len(token)

    def whole(text: str) -> np.ndarray:
        return np.array(tok.encode(text, add_special_tokens=False).ids, dtype)

    def later(new: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = []
        for at in range(0, len(new), 256):
            ids.append(np.array(tok.encode_batch_fast([" " + " ".join(new[at : at + 256])], add_special_tokens=False)[0].ids, dtype))
        ids = np.concatenate(ids)
        sizes = pc.binary_length(pa.array(new, pa.large_string())).to_numpy()
        return ids, np.searchsorted(np.cumsum(n_bytes[ids]), np.cumsum(sizes + 1), side="right")

    memo, first, odd = _PieceIds(later, dtype), functools.lru_cache(100_000)(whole), Disputed(disputed)

    def joined(cut: pa.LargeListArray) -> list[np.ndarray]:
        """The ids of texts cut into pieces."""
        strings = cut.flatten().dictionary_encode()
        codes, distinct = strings.indices.to_numpy(), strings.dictionary.to_numpy(zero_copy_only=False)
        begin = cut.offsets.to_numpy()[:-1] - cut.offsets[0].as_py()
        is_first = np.zeros(len(codes), bool)
        is_first[begin] = True
        wanted = np.zeros(len(distinct), bool)  # as a later piece
        wanted[codes[~is_first]] = True
        number = np.zeros(len(distinct), np.int64)
        number[wanted] = memo.numbers(distinct[wanted].tolist())
        # a text's first piece has no space before it: numbers beyond the memo's
        heads = [first(p) for p in distinct[codes[begin]].tolist()]
        ids = np.concatenate([memo.ids, *heads])
        ends = np.concatenate([memo.ends, memo.ends[-1] + np.cumsum([len(x) for x in heads])])
        number = number[codes]
        number[begin] = len(memo.ends) - 1 + np.arange(len(begin))
        lens = np.diff(ends)[number]
        place = np.cumsum(lens)
        at = np.repeat(ends[number] - place + lens, lens)
        at += np.arange(len(at))
        return np.split(ids[at], place[begin[1:] - 1])

    def encode(texts: list[str]) -> list[np.ndarray]:
        out: list = [None] * len(texts)
        plain, spaced = [], []
        for i, t in enumerate(texts):
            if SPECIAL in t or not odd.free(t):
                out[i] = whole(t)
            else:
                (spaced if has_wide_space(t) else plain).append(i)
        if plain:
            for i, ids in zip(plain, joined(pc.split_pattern(pa.array([texts[i] for i in plain], pa.large_string()), " "))):
                out[i] = ids
        if spaced:
            for i, ids in zip(spaced, joined(pa.array([pieces(texts[i]) for i in spaced], pa.large_list(pa.large_string())))):
                out[i] = ids
        return out

    return encode


def _bounds(docs: DataFrame, shards: int, n_docs: int) -> list[tuple]:
    """Upper bounds of all shards but the last, as (has an id, id, hash),
    from a sample of SAMPLE rows a shard, MOST_SAMPLED at most."""
    most = min(SAMPLE * shards, MOST_SAMPLED)
    share = min(1.0, most / max(n_docs, 1))
    rows = docs.sample(False, share, 17).select("doc_id", F.xxhash64("text").alias("h")).collect()
    keys = sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["h"]) for r in rows)
    return [keys[i * len(keys) // shards] for i in range(1, shards)] if keys else []


def _packed(docs: DataFrame, shards: int, n_docs: int) -> DataFrame:
    """(shard, doc_id, h, size, z): texts compressed for the shuffle, with
    their range of ids."""
    bounds = _bounds(docs, shards, n_docs)
    names = ["shard", "doc_id", "h", "size", "z"]
    kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary())

    def run(batches):
        codec = pa.Codec("zstd", compression_level=3)
        for b in batches:
            out = []
            for doc_id, h, text in zip(*(b.column(c).to_pylist() for c in range(3))):
                data = text.encode()
                out.append((bisect_right(bounds, (doc_id is not None, doc_id or 0, h)), doc_id, h, len(data), codec.compress(data, asbytes=True)))
            cols = list(zip(*out)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)

    return docs.select("doc_id", F.xxhash64("text").alias("h"), "text").mapInArrow(run, "shard int, doc_id long, h long, size int, z binary")


def write_token_files(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int,
    folder: str | None = None,
    seq_len: int = SEQ_LEN,
    rows_per_batch: int = ROWS_PER_BATCH,
    shards: int | None = None,
) -> DataFrame:
    """Write ``docs(doc_id, text)``; returns the manifest: one row per shard
    in stream order, with ``first_token`` and ``first_sequence`` counted over
    all shards.  Shards are ranges of ``doc_id`` found by sampling, one task
    each: as many as there are shuffle partitions, more where these would hold
    more than SHARD_DOCS documents; a task holds one record batch and one
    document at a time."""
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    folder = folder or shared_folder(spark, "tokens")
    n_docs = docs.count()
    n = shards or max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(n_docs / SHARD_DOCS))
    tok = Tokenizer.from_file(tokenizer_path)
    id_type, disputed = _id_type(tok.get_vocab_size()), disputed_characters(tok)

    names = [f.split()[0] for f in SHARD_ROWS.split(", ")]

    def closed(writer, shard, first) -> pa.RecordBatch:
        writer.close()
        row = [shard, first, writer.path, writer.index_path, writer.docs, writer.sequences, writer.total]
        return pa.RecordBatch.from_pylist([dict(zip(names, row))])

    def write(batches):
        dtype = id_type.to_pandas_dtype()
        encode = held(("library", tokenizer_path, str(id_type)), lambda: library_encoder(tokenizer_path, dtype, disputed))
        codec, end = pa.Codec("zstd"), np.array([end_id], dtype)
        writer, shard, first = None, None, None
        for b in batches:
            group = np.cumsum(b.column(2).to_numpy(), dtype=np.int64) // SLICE
            cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), b.num_rows]
            for at, to in zip(cuts, cuts[1:]):
                rows = [b.column(c).slice(at, to - at).to_pylist() for c in range(4)]
                texts = [codec.decompress(z, size, asbytes=True).decode() for size, z in zip(rows[2], rows[3])]
                for s, doc_id, ids in zip(rows[0], rows[1], encode(texts)):
                    if writer is not None and s != shard:
                        yield closed(writer, shard, first)
                        writer = None
                    if writer is None:
                        writer, shard, first = _ShardWriter(folder, seq_len, rows_per_batch, id_type), s, doc_id
                    writer.add(doc_id, np.append(ids, end))
        if writer is not None:
            yield closed(writer, shard, first)

    text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    packed = _packed(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text), n, n_docs)
    ordered = packed.repartitionById(n, "shard").sortWithinPartitions("shard", F.col("doc_id").asc_nulls_first(), "h")
    manifest = cut_lineage(ordered.select("shard", "doc_id", "size", "z").mapInArrow(write, SHARD_ROWS), "token-manifest")
    # one row per shard: a small table, whatever the number of documents
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("first_token", F.coalesce(F.sum("n_tokens").over(before), F.lit(0))).withColumn(
        "first_sequence", F.coalesce(F.sum("n_sequences").over(before), F.lit(0))
    )


def open_sequences(path: str) -> list:
    """Record batches of a shard, memory-mapped where the file system has
    local files: no id is copied until it is used."""
    fs, p = file_system(path)
    source = pa.memory_map(p) if fs.type_name == "local" else fs.open_input_file(p)
    return list(pa.ipc.open_stream(source))


def sequence(batches: list, row: int, column: str = "input_ids") -> pa.Array:
    """Row ``row`` of a shard as a slice of the mapped file (no copy; ids
    become a numpy view by ``to_numpy()``, masks stay bits): all batches but
    the last have the same number of rows, so its place follows by division."""
    per = batches[0].num_rows
    col = batches[row // per].column(batches[0].schema.get_field_index(column))
    size = col.type.list_size
    at = (col.offset + row % per) * size
    return col.values.slice(at, size)


def read_documents(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """Read the shard files back: one row per document with its place in the
    whole stream and its ids' checksum, from the files alone.  Batches are
    streamed; a task holds one batch."""

    def read(batches):
        for rows in batches:
            for m in rows.to_pylist():
                yield from read_shard(m)

    columns = "doc_id long, start long, n_tokens long, ids_crc32 long, n_unmasked long"
    shards = manifest.select("path", "index_path", "first_token", "shard").repartition(
        int(spark.conf.get("spark.sql.shuffle.partitions")), "shard"
    )
    return shards.mapInArrow(read, columns)


def read_shard(m: dict):
    """The documents of one shard, found by the document-end mask; both files
    are streamed."""
    fs, p = file_system(m["index_path"])
    with fs.open_input_stream(p) as f:
        names = (d for b in pa.ipc.open_stream(f) for d in b.column("doc_id").to_pylist())
        yield from _found(m, names)
        if next(names, m) is not m:
            raise ValueError(f"{m['path']}: more documents in the index than in the file")


def _found(m: dict, names):
    fs, p = file_system(m["path"])
    crc, size, start, out = 0, 0, m["first_token"], []
    with fs.open_input_stream(p) as f:
        for b in pa.ipc.open_stream(f):
            ids = b.column(0).flatten().to_numpy(zero_copy_only=True)
            mask, ends = (b.column(c).flatten().to_numpy(zero_copy_only=False) for c in (1, 2))
            ids = ids[: int(mask.sum())].astype("<u4")
            at = 0
            for e in np.flatnonzero(ends):
                crc = zlib.crc32(ids[at : e + 1].tobytes(), crc)
                size += int(e) + 1 - at
                name = next(names, m)
                if name is m:
                    raise ValueError(f"{m['path']}: fewer documents in the index than in the file")
                out.append((name, start, size, crc, size))
                start, size, crc, at = start + size, 0, 0, int(e) + 1
            crc = zlib.crc32(ids[at:].tobytes(), crc)
            size += len(ids) - at
            if len(out) >= 10_000:
                yield _documents(out)
                out = []
    if size:
        raise ValueError(f"{m['path']}: the last document has no end")
    if out:
        yield _documents(out)


def _documents(rows: list) -> pa.RecordBatch:
    names = ["doc_id", "start", "n_tokens", "ids_crc32", "n_unmasked"]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=names)
