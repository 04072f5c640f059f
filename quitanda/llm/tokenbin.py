"""Operator 10: token ids in a bit-packed binary format.

Format: documents in ascending doc_id order form shards, a shard is a sequence
of blocks, a block is one row of a Parquet table: shard, block, bits, first (ids
before it in its shard), n_ids, payload (ids packed at ``bits`` bits each,
little-endian bit order, no gaps), doc_ids and offsets (first id of each
document in the block + total).  ``bits`` is the least that holds the vocabulary's largest id.  A
block closes at the first document end after ``BLOCK_IDS`` ids, so the ids of a
document are ``unpack(payload, bits, offsets[i], offsets[i + 1])``: one numpy
call that touches only their bytes.  ``shard_starts`` turns the shards' totals into
global positions, so no payload is shuffled to be read; Parquet's own commit makes shards appear once even if
executors are lost or tasks run twice.

Encoding: a space before another character always begins a new piece of the
byte-level pre-tokenizer, so words are encoded once per worker and looked up
(a bounded table); texts with two spaces in a row or a special token's string
are encoded whole.  Results equal ``Tokenizer.encode`` on the text (tested).

Defined cases: null text is empty; every document ends with id 0; an empty
document is that one id; rows that repeat a doc_id follow each other in the
order of their text's hash; null doc_ids come first; a doc_id or a whole row that
is repeated for a third of the table is spread over several shards; very long
texts are encoded whole, each in one block; an empty table has no blocks; only
``id_col`` and ``text_col`` are read, so other columns can have any name.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quitanda.session import scratch_path

END_ID = 0
BLOCK_IDS = 1 << 16
#: Pieces kept in a task's table.
KNOWN_PIECES = 300_000
#: Shards whose starts are broadcast (16 bytes each); more are joined.
BROADCAST_SHARDS = 1 << 20
TOKENIZER = "byte_bpe_50k.json"

BLOCK_SCHEMA = ("shard int, block int, bits int, first long, n_ids long, payload binary, doc_ids array<long>, "
                "offsets array<long>")


def bits_for(vocabulary: int) -> int:
    """Least bits that hold the ids 0 to vocabulary - 1."""
    return max(1, int(vocabulary - 1).bit_length())


#: Widths of whole bytes are plain arrays.
_WHOLE = {8: "<u1", 16: "<u2", 32: "<u4"}


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids at ``bits`` bits each, in groups that bound the temporary bit table."""
    if bits in _WHOLE:
        return ids.astype(_WHOLE[bits]).tobytes()
    step = 1 << 15  # a multiple of 8 ids ends on a byte
    out = []
    for a in range(0, len(ids), step):
        part = ids[a:a + step].astype("<u4")
        table = np.unpackbits(part.view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")[:, :bits]
        out.append(np.packbits(table.reshape(-1), bitorder="little").tobytes())
    return b"".join(out)


def unpack(payload: bytes, bits: int, start: int, stop: int) -> np.ndarray:
    """Ids ``start`` to ``stop`` of a block, reading only their bytes."""
    if stop <= start:
        return np.zeros(0, np.uint32)
    if bits in _WHOLE:
        return np.frombuffer(payload, _WHOLE[bits], stop - start, start * bits // 8).astype(np.uint32)
    out = []
    step = 1 << 15
    for a in range(start, stop, step):
        b = min(a + step, stop)
        first = a * bits
        raw = np.frombuffer(payload, np.uint8, (b * bits + 7) // 8 - first // 8, first // 8)
        flat = np.unpackbits(raw, bitorder="little")[first % 8:first % 8 + (b - a) * bits].reshape(-1, bits)
        full = np.zeros((b - a, 32), np.uint8)
        full[:, :bits] = flat
        out.append(np.packbits(full, axis=1, bitorder="little").view("<u4").reshape(-1))
    return np.concatenate(out)


#: Pieces of these characters alone are split here; what they split into is the
#: byte-level pre-tokenizer's fixed pattern, written for this alphabet.
_LETTER = "A-Za-zÀ-ÖØ-öø-ÿŒœ"
_PLAIN = re.compile(rf"[ -~\n{_LETTER}]+")
_SPLIT = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[0-9]+| ?[^\s{_LETTER}0-9]+|\s+(?!\S)|\s+")


def byte_characters() -> dict[int, str]:
    """The character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = (b for b in range(256) if b not in set(shown))
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class Encoder:
    """Ids of texts by the tokenizers library, with a bounded table of pieces."""

    def __init__(self, path: str, known: int = KNOWN_PIECES):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # pieces without their space, and pre-tokens inside pieces that are none themselves
        self.known, self.pieces, self.words = known, {}, {}
        spec = json.loads(self.tokenizer.to_str())
        split = spec["pre_tokenizer"] or {}
        self.by_piece = (split.get("type") == "ByteLevel" and split.get("use_regex") and not split["add_prefix_space"]
                         and spec["normalizer"] is None and spec["model"]["type"] == "BPE")
        self.model, self.bytes = self.tokenizer.model, byte_characters()

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def _ids(self, token: str) -> bytes:
        """Ids of one pre-token, by the library's model."""
        if token.isascii() and token[1:].isalpha():  # only a leading space is shown as another character
            shown = "\u0120" + token[1:] if token[0] == " " else token
        else:
            shown = token.encode().decode("latin-1").translate(self.bytes)
        return array("I", [t.id for t in self.model.tokenize(shown)]).tobytes()

    def _piece(self, piece: str) -> bytes:
        """Ids of a piece: those of its pre-tokens; letters with or without a leading space are one."""
        if piece.isalpha() or (piece[0] == " " and piece[1:].isalpha()):
            return self._ids(piece)
        out = b""
        for x in _SPLIT.findall(piece):
            ids = (self.pieces.get(x[1:]) if x[0] == " " else None) or self.words.get(x)
            if ids is None:
                ids = self._ids(x)
                if len(self.words) < self.known:
                    self.words[x] = ids
            out += ids
        return out

    def _learn(self, new: set[str]) -> dict[str, bytes]:
        out = {p: self._piece(p) for p in new if _PLAIN.fullmatch(p)}
        rest = list(new.difference(out))
        out.update(zip(rest, (x.tobytes() for x in self._whole(rest))))
        return out

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        odd = [i for i, t in enumerate(texts)
               if not self.by_piece or "  " in t or any(s in t for s in self.special)]
        whole = dict(zip(odd, self._whole([texts[i] for i in odd])))
        split, new, firsts = {}, set(), set()
        for i, t in enumerate(texts):
            if i not in whole:
                first, *rest = t.split(" ")  # the first piece has no space before it
                found = list(map(self.pieces.get, rest))
                gaps = [(k, rest[k]) for k, ids in enumerate(found) if ids is None] if None in found else []
                split[i] = first, found, gaps
                new.update(w for _, w in gaps)
                firsts.add(first)
        firsts.discard("")
        begin = self._learn(firsts)
        begin[""] = b""
        now = {p[1:]: ids for p, ids in self._learn({" " + w for w in new}).items()}
        out = []
        for i in range(len(texts)):
            if i in whole:
                out.append(whole[i])
                continue
            first, found, gaps = split[i]
            for k, w in gaps:
                found[k] = now[w]
            out.append(np.frombuffer(begin[first] + b"".join(found), np.uint32))
        if len(self.pieces) < self.known:  # the earlier ones stay, which the common words are among
            self.pieces.update(now)
        return out


_encoders: dict[tuple[str, int], Encoder] = {}


def encoder_of(path: str, known: int = KNOWN_PIECES) -> Encoder:
    """The worker's encoder: its vocabulary is read, and its table of pieces filled, once for all tasks."""
    if (path, known) not in _encoders:
        _encoders[path, known] = Encoder(path, known)
    return _encoders[path, known]


def _pack_shard(path: str, bits: int, block_ids: int, end_id: int, known: int):
    from quitanda.llm import kernel as K

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, shard, block = encoder_of(path, known), TaskContext.get().partitionId(), 0
        ids, docs = [], []
        held = first = 0

        def close():
            nonlocal block, held, first
            offsets = np.concatenate(([0], np.cumsum([len(x) for x in ids])))
            row = pa.RecordBatch.from_arrays([
                pa.array([shard], pa.int32()), pa.array([block], pa.int32()), pa.array([bits], pa.int32()),
                pa.array([first], pa.int64()), pa.array([held], pa.int64()), pa.array([pack(np.concatenate(ids), bits)], pa.binary()),
                pa.array([docs], pa.list_(pa.int64())), pa.array([offsets.tolist()], pa.list_(pa.int64()))],
                names=["shard", "block", "bits", "first", "n_ids", "payload", "doc_ids", "offsets"])
            block, held, first = block + 1, 0, first + held
            ids.clear()
            docs.clear()
            return row

        for batch in batches:
            for part in K.chunks(batch, "text", 1 << 19):
                texts = [t or "" for t in part.column("text").to_pylist()]
                for doc, got in zip(part.column("doc_id").to_pylist(), encoder.encode(texts)):
                    ids.append(np.append(got, np.uint32(end_id)))
                    docs.append(doc)
                    held += len(ids[-1])
                    if held >= block_ids:
                        yield close()
            pa.default_memory_pool().release_unused()  # the worker stays, its spare memory need not
        if ids:
            yield close()
    return run


def write_tokens(docs: DataFrame, out: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                 block_ids: int = BLOCK_IDS, end_id: int = END_ID, known: int = KNOWN_PIECES) -> None:
    """Encode ``docs`` and write their blocks, in ascending doc_id order, to the folder ``out``.

    ``tokenizer`` is a tokenizers JSON file that every worker can open; a worker keeps the ids
    of ``known`` pieces.
    """
    from tokenizers import Tokenizer
    bits = bits_for(Tokenizer.from_file(tokenizer).get_vocab_size(with_added_tokens=True))
    # equal rows of different tasks stay apart, so that no repeated row fills a shard
    keyed = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                        F.xxhash64(text_col).alias("key"), F.spark_partition_id().alias("part"))
    order = ["doc_id", "key", "part"]
    ordered = keyed.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    ordered.mapInArrow(_pack_shard(tokenizer, bits, block_ids, end_id, known), BLOCK_SCHEMA).write.parquet(out)


def shard_starts(blocks: DataFrame) -> DataFrame:
    """(shard, shard_first): ids before each shard.  One row per shard, as many as the write had tasks."""
    shards = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    return shards.select("shard", (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("shard_first"))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            offsets = np.array(row["offsets"], np.int64)
            raw = memoryview(unpack(row["payload"], row["bits"], 0, row["n_ids"]).astype("<u4", copy=False)).cast("B")
            cuts = (offsets * 4).tolist()
            crcs = [zlib.crc32(raw[a:b]) for a, b in zip(cuts, cuts[1:])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(row["doc_ids"], pa.int64()), pa.array(offsets[:-1] + row["first_id"]),
                 pa.array(np.diff(offsets)), pa.array(crcs, pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"])


def read_documents(blocks: DataFrame) -> DataFrame:
    """One row per document, read back from the blocks: doc_id, start, n_tokens, ids_crc32."""
    starts = shard_starts(blocks)
    if blocks.select("shard").distinct().count() <= BROADCAST_SHARDS:
        starts = F.broadcast(starts)
    placed = blocks.join(starts, "shard").withColumn("first_id", F.col("shard_first") + F.col("first"))
    return placed.select("bits", "n_ids", "payload", "doc_ids", "offsets", "first_id").mapInArrow(
        _read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def tokenized(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Write ``docs`` below the shared scratch folder and read the documents back."""
    spark = docs.sparkSession
    out = scratch_path(spark, "llm-tokens")
    write_tokens(docs, out, tokenizer, id_col, text_col, **options)
    return read_documents(spark.read.schema(BLOCK_SCHEMA).parquet(out))
