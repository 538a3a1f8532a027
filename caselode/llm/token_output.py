"""Texts to token ids to compressed binary segments, and back.

Documents are sorted by id over all partitions. Each task encodes its documents with the tokenizer,
puts their ids behind each other, and writes segments: rows of a Parquet table whose binary column
holds the coded blocks, each with its number of ids, its length and its checksum. A segment has
whole documents, and can be read without any other.
"""

import os
import struct
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import range_coder
from . import words as w
from .common import id_and_text, map_batches

MAGIC = b"CLTOK1\0\0"
END_ID = 0
#: Ids of one block, and of one segment (more where a document is longer).
BLOCK_IDS, LEAST_BLOCK_IDS, SEGMENT_IDS = 4096, 512, range_coder.LANES * 4096
#: Distinct pieces of text whose ids a worker keeps, about 60 MB; beyond that it starts anew.
KEPT_PIECES = 1_000_000
#: Bytes of text that are encoded together.
TEXT_BYTES = 2 << 20
#: First characters of a text that, after its id, decide which task writes it; its order goes by the whole text.
PLACE_CHARS = 64

_HEAD = struct.Struct("<8sQI")  # magic, ids, blocks
_BLOCK = struct.Struct("<III")  # ids, bytes, checksum of the ids
_SPACE = ~w.space_words()


class PieceEncoder:
    """Encodes texts with a `tokenizers` file whose pre-tokenizer never joins a word with what follows
    white space (byte-level BPE), keeping the ids of pieces seen before.

    A text is cut where the pre-tokenizer cuts it in any case: at runs of white space, whose last
    character goes with the next word if it is a space. Pieces that are equal have equal ids, so
    each is encoded by the library once. Texts with other than ASCII white space, or with what may be
    a special token, are given to the library whole.
    """

    def __init__(self, path):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self._forget()

    def _forget(self):
        self.keys = np.zeros(0, np.uint64)  # sorted
        self.begin, self.size = np.zeros(0, np.int32), np.zeros(0, np.int32)
        self.ids = np.zeros(0, np.int32)

    def _learn(self, keys, texts):
        """Keep the ids of new pieces; `keys` are sorted."""
        if len(self.keys) + len(keys) > KEPT_PIECES:
            self._forget()
        encoded = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        size = np.fromiter(map(len, encoded), np.int32, len(encoded))
        ids = np.fromiter(chain.from_iterable(encoded), np.int32, int(size.sum()))
        begin = (len(self.ids) + np.cumsum(size) - size).astype(np.int32)
        at = np.searchsorted(self.keys, keys)
        self.keys, self.begin = np.insert(self.keys, at, keys), np.insert(self.begin, at, begin)
        self.size, self.ids = np.insert(self.size, at, size), np.concatenate([self.ids, ids])

    def _find(self, keys):
        """Places of keys in the kept pieces, and which are there."""
        if not len(self.keys):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return at, self.keys[at] == keys

    def encode(self, data, borders):
        """(ids, first): the ids of all texts in a row, and where each text's begin."""
        n = len(borders) - 1
        whole = _odd_texts(data, borders)
        starts = _piece_starts(data, borders)
        ends = np.append(starts[1:], len(data))
        keys = w.Words(data, borders, _SPACE).span_hashes(starts, ends)
        distinct, first, which = np.unique(keys, return_index=True, return_inverse=True)
        _, known = self._find(distinct)
        if not known.all():
            if len(self.keys) + len(distinct) > KEPT_PIECES:
                self._forget()
                known[:] = False
            new = np.flatnonzero(~known)
            raw, a, b = data.tobytes(), starts[first[new]].tolist(), ends[first[new]].tolist()
            self._learn(distinct[new], [raw[i:j].decode() for i, j in zip(a, b)])
        place, _ = self._find(distinct)
        begin, size = self.begin[place][which], self.size[place][which]
        total = np.concatenate([[0], np.cumsum(size)])
        ids = self.ids[np.repeat(begin - total[:-1], size) + np.arange(total[-1])]
        cut = total[np.searchsorted(starts, borders)]
        if not whole.any():
            return ids, cut
        texts = [ids[cut[i] : cut[i + 1]] for i in range(n)]
        for i in np.flatnonzero(whole).tolist():
            text = data[borders[i] : borders[i + 1]].tobytes().decode()
            texts[i] = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.int32)
        return np.concatenate(texts), np.concatenate([[0], np.cumsum([len(x) for x in texts])])


def _piece_starts(data, borders):
    """Where the pieces begin that the pre-tokenizer never joins: they cover all bytes."""
    if not len(data):
        return np.zeros(0, np.int64)
    space = _SPACE[data]
    mark = np.zeros(len(data) + 1, bool)
    edge = np.zeros(len(data) + 1, bool)
    edge[borders] = True
    mark[borders] = True
    inner = ~edge[1:-1]
    mark[1:-1] |= inner & space[1:] & ~space[:-1]  # white space begins
    word = np.flatnonzero(inner & ~space[1:] & space[:-1]) + 1
    mark[word - 1] = True  # the last of the white space is a piece, or the start of one
    mark[word[data[word - 1] != 0x20]] = True
    return np.flatnonzero(mark[:-1])


_SUSPECT = np.zeros(256, bool)
_SUSPECT[[0, *range(0x1C, 0x20), 0x3C, 0xC2, 0xE1, 0xE2, 0xE3]] = True


def _odd_texts(data, borders):
    """Texts with other than ASCII white space, separators 1C to 1F, NUL, or "<|"."""
    at = np.flatnonzero(_SUSPECT[data])
    padded = np.append(data, [0, 0])
    a, b, c = data[at], padded[at + 1], padded[at + 2]
    hit = (a < 0x20) | (a == 0x3C) & (b == 0x7C)
    hit |= (a == 0xC2) & ((b == 0x85) | (b == 0xA0))
    hit |= (a == 0xE1) & ((b == 0x9A) | (b == 0xA0))
    hit |= (a == 0xE2) & (b == 0x80) & (((c >= 0x80) & (c <= 0x8F)) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF))
    hit |= (a == 0xE2) & (b == 0x81) & ((c == 0x9F) | (c == 0xA0))
    hit |= (a == 0xE3) & (b == 0x80) & (c == 0x80)
    odd = np.zeros(len(borders) - 1, bool)
    odd[np.searchsorted(borders, at[hit], "right") - 1] = True
    return odd


_encoders = {}


def _encoder(path) -> PieceEncoder:
    """The worker's encoder; it keeps its pieces from task to task."""
    if path not in _encoders:
        _encoders[path] = PieceEncoder(path)
    return _encoders[path]


def pack(ids) -> bytes:
    """A segment: its ids as coded blocks with checksums."""
    size = min(BLOCK_IDS, max(LEAST_BLOCK_IDS, -(-len(ids) // 512)))
    blocks = [ids[i : i + size] for i in range(0, len(ids), size)]
    out = [_HEAD.pack(MAGIC, len(ids), len(blocks))]
    for block, coded in zip(blocks, range_coder.encode(blocks)):
        out += [_BLOCK.pack(len(block), len(coded), range_coder.checksum(block)), coded]
    return b"".join(out)


def block_parts(payload):
    """(number of ids, coded bytes, checksum) of a segment's blocks."""
    magic, n_ids, n_blocks = _HEAD.unpack_from(payload)
    if magic != MAGIC:
        raise ValueError("not a token segment")
    at, out = _HEAD.size, []
    for _ in range(n_blocks):
        size, length, crc = _BLOCK.unpack_from(payload, at)
        at += _BLOCK.size
        out.append((size, payload[at : at + length], crc))
        at += length
    if sum(x[0] for x in out) != n_ids or at != len(payload):
        raise ValueError("a token segment is cut off")
    return out


def unpack(payloads) -> list[np.ndarray]:
    """The ids of some segments; fails if a block does not match its checksum."""
    parts = [block_parts(p) for p in payloads]
    flat = [x for p in parts for x in p]
    ids = range_coder.decode([x[1] for x in flat], [x[0] for x in flat])
    for own, (_, _, crc) in zip(ids, flat):
        if range_coder.checksum(own) != crc:
            raise ValueError("a block does not match its checksum")
    out, at = [], 0
    for p in parts:
        out.append(np.concatenate([np.zeros(0, np.int32), *ids[at : at + len(p)]]))
        at += len(p)
    return out


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, id_col="doc_id", text_col="text") -> None:
    """Write the ids of all texts, each followed by END_ID, in ascending order of id (nulls first).

    The table has a row per segment: part and segment (their order is the order of the documents),
    doc_ids, sizes (ids of each document with its end) and payload. A null text is an empty one.
    Rows that repeat an id are written each, next to each other, in the order of their texts; they are spread
    over tasks by their first characters, so only rows that agree in id and PLACE_CHARS characters share one. An
    empty table writes no segment. `tokenizer_path` must be readable on every executor.
    """
    rows = id_and_text(docs, id_col, text_col)
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"part int, segment int, doc_ids array<{id_type}>, sizes array<long>, payload binary"

    def encode(batches):
        encoder, part = _encoder(tokenizer_path), TaskContext.get().partitionId()
        segment, held, held_ids, held_sizes, count = 0, [], [], [], 0

        def row():
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int32()),
                    pa.array([segment], pa.int32()),
                    pa.ListArray.from_arrays([0, sum(map(len, held_ids))], pa.concat_arrays(held_ids)),
                    pa.array([np.concatenate(held_sizes)], pa.list_(pa.int64())),
                    pa.array([pack(np.concatenate(held))], pa.binary()),
                ],
                names=["part", "segment", "doc_ids", "sizes", "payload"],
            )

        for batch in batches:
            for a, b, data, borders in w.pieces(batch.column("text"), TEXT_BYTES):
                ids, first = encoder.encode(data, borders)
                with_end = np.insert(ids, first[1:], END_ID)
                held.append(with_end)
                held_ids.append(batch.column("id")[a:b])
                held_sizes.append(np.diff(first) + 1)
                count += len(with_end)
                if count >= SEGMENT_IDS:
                    yield row()
                    segment, held, held_ids, held_sizes, count = segment + 1, [], [], [], 0
        if held:
            yield row()

    ordered = rows.repartitionByRange("id", F.substring("text", 1, PLACE_CHARS)).sortWithinPartitions("id", "text")
    ordered.mapInArrow(encode, schema).write.option("compression", "none").parquet(path)


def read_tokens(spark: SparkSession, path: str, with_ids=True) -> DataFrame:
    """(doc_id, part, segment, offset, n_tokens, ids_crc32, ids) of every document in a token table.

    `offset` counts the segment's ids before the document. `ids` is null unless `with_ids`.
    """
    segments = spark.read.parquet(path)
    id_type = segments.schema["doc_ids"].dataType.elementType.simpleString()
    schema = (
        f"doc_id {id_type}, part int, segment int, offset long, n_tokens long, ids_crc32 long, ids array<int>"
    )

    def decode(batch):
        names = ("part", "segment", "doc_ids", "sizes", "payload")
        part, segment, doc_ids, sizes, payload = (batch.column(x) for x in names)
        for i in range(batch.num_rows):
            ids = unpack([payload[i].as_buffer().to_pybytes()])[0]
            own = np.asarray(sizes[i].values)
            n, first = len(own), np.concatenate([[0], np.cumsum(own)])
            if first[-1] != len(ids):
                raise ValueError("a segment's documents do not add up to its ids")
            raw = memoryview(ids.astype("<u4")).cast("B")
            crc = [range_coder.zlib.crc32(raw[4 * x : 4 * y]) for x, y in zip(first[:-1].tolist(), first[1:].tolist())]
            lists = pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(ids)) if with_ids else pa.nulls(n)
            yield {
                "doc_id": doc_ids[i].values, "part": np.full(n, part[i].as_py()),
                "segment": np.full(n, segment[i].as_py()), "offset": first[:-1], "n_tokens": own,
                "ids_crc32": np.array(crc, np.int64), "ids": lists,
            }

    return map_batches(segments, decode, schema)


def segment_starts(spark: SparkSession, path: str) -> DataFrame:
    """(part, segment, before): the ids of all segments before each. One row per part is summed in one task."""
    sizes = spark.read.parquet(path).select(
        "part", "segment", F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x).alias("n")
    )
    parts = sizes.groupBy("part").agg(F.sum("n").alias("total"))
    parts = parts.select(
        "part", F.coalesce(F.sum("total").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("earlier")
    )
    inside = Window.partitionBy("part").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    own = sizes.select("part", "segment", F.coalesce(F.sum("n").over(inside), F.lit(0)).alias("inside"))
    return own.join(parts, "part").select("part", "segment", (F.col("earlier") + F.col("inside")).alias("before"))


def token_digests(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, read back from a token table."""
    read = read_tokens(spark, path, with_ids=False).drop("ids")
    return read.join(segment_starts(spark, path), ["part", "segment"]).select(
        "doc_id", (F.col("before") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32"
    )
