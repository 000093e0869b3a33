"""Token ids of documents as blocks of one long id array with Elias-Fano document boundaries.

The file format is a Parquet folder with a row per block. A block holds the ids of consecutive
documents, end ids included, as little-endian 16- or 32-bit integers, and two sequences that never
fall, as Elias-Fano code: where each document ends, and the documents' own ids, less the first of them
(documents without an id come before these, and are only counted). Of each offset the low bits are
packed and the high part is a set bit in a bitmap at (high part + index); a table of every 256th set
bit answers select, so one offset is found without decoding the rest, in about two bits more than
the low bits for each document. Blocks are numbered by part (a range of doc_id) and block, and
know where they start in their part; `directory` has where each part starts.
"""

from __future__ import annotations

import os
import re
import zlib
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F


END_ID = 0
# Ids of a block; a document longer than that has a block of its own.
BLOCK_IDS = 1 << 20
SELECT_STEP = 256
# Encoded pieces that a worker remembers (some 30 bytes each), bytes of text that it encodes together,
# new pieces that it gives the tokenizer in a line, and pieces whose ids it puts together at once.
REMEMBERED = 500_000
TOGETHER = 1 << 20
LINE = 200
STRETCH = 1 << 17

BLOCKS = (
    "part int, block int, start long, n_docs long, n_ids long, width int, ids binary, "
    "low_bits int, low binary, high binary, selects binary, "
    "n_unnamed int, first_id long, id_low_bits int, id_low binary, id_high binary, id_selects binary"
)
ENTRIES = "part int, doc_id long, start long, n_tokens long, ids_crc32 long"


@dataclass(frozen=True)
class EliasFano:
    """`n` non-decreasing numbers; `low_bits` of each in `low`, the rest in the bitmap `high`."""

    n: int
    low_bits: int
    low: bytes
    high: bytes
    selects: bytes

    @staticmethod
    def encode(values: np.ndarray) -> EliasFano:
        n = len(values)
        top = int(values[-1]) if n else 0
        low_bits = max(0, (top // n).bit_length() - 1) if n else 0
        parts = values.astype(np.uint64)
        bits = (parts[:, None] >> np.arange(low_bits, dtype=np.uint64)) & np.uint64(1)
        low = np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes()
        ones = (parts >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        bitmap = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
        bitmap[ones] = 1
        high = np.packbits(bitmap, bitorder="little").tobytes()
        return EliasFano(n, low_bits, low, high, ones[::SELECT_STEP].astype("<u4").tobytes())

    def _low_of(self, index: int) -> int:
        first = index * self.low_bits
        raw = self.low[first // 8 : (first + self.low_bits + 7) // 8]
        return (int.from_bytes(raw, "little") >> (first % 8)) & ((1 << self.low_bits) - 1)

    def _select(self, index: int) -> int:
        """Position of the set bit number `index`: from the nearest known one before it on."""
        known = int.from_bytes(self.selects[index // SELECT_STEP * 4 :][:4], "little")
        wanted, byte = index % SELECT_STEP, known // 8
        word = self.high[byte] >> (known % 8) << (known % 8)
        while (ones := word.bit_count()) <= wanted:
            wanted, byte = wanted - ones, byte + 1
            word = self.high[byte]
        for _ in range(wanted):
            word &= word - 1
        return byte * 8 + (word & -word).bit_length() - 1

    def __getitem__(self, index: int) -> int:
        """One number, without decoding the others."""
        if not 0 <= index < self.n:
            raise IndexError(index)
        return (self._select(index) - index) << self.low_bits | self._low_of(index)

    def decode(self) -> np.ndarray:
        """All numbers at once."""
        ones = np.flatnonzero(np.unpackbits(np.frombuffer(self.high, np.uint8), bitorder="little"))[: self.n]
        high = (ones - np.arange(self.n)).astype(np.int64) << self.low_bits
        bits = np.unpackbits(np.frombuffer(self.low, np.uint8), bitorder="little")[: self.n * self.low_bits]
        weights = 1 << np.arange(self.low_bits, dtype=np.int64)
        return high + bits.reshape(self.n, self.low_bits).astype(np.int64) @ weights


def encode_names(names: list[int | None]) -> tuple[int, int | None, EliasFano]:
    """(how many nulls, the first id, code of the ids less the first) of ascending ids, nulls first."""
    unnamed = names.count(None)
    known = np.array(names[unnamed:], np.int64)
    # Differences of signed ids fit unsigned numbers, also where they overflow.
    above = known.view(np.uint64) - known.view(np.uint64)[:1] if len(known) else known
    return unnamed, int(known[0]) if len(known) else None, EliasFano.encode(above)


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return tokenizer


# A blank between two characters that are no white space. Byte-level BPE with the usual pattern
# always starts a piece at such a blank, and merges never leave a piece.
CUT = re.compile(r"(?<=\S) (?=\S)")
# Texts without any of these can be cut at every blank and before every line feed.
ODD = "|".join(
    [r"\A[ \n]", r"[ \n]\z", "  ", r"\n ", r" \n", r"\n\n"]
    + [f"[{''.join(c for c in map(chr, range(0x3001)) if c.isspace() and c not in ' \n')}]"]
)
# Marks that are a piece of their own behind a letter.
MARKS = ".,;:!?"
MARKED = rf"\p{{L}}[{MARKS}]\z"


def pieces_of(texts: pa.Array) -> list[tuple[np.ndarray, pa.ListArray]]:
    """(which texts, their pieces): pieces that follow a blank, without it, or a line feed, with it.

    A text's first piece follows nothing. Texts with unusual white space are cut at single blanks only.
    """
    odd = pc.match_substring_regex(texts, ODD)
    plain = pc.split_pattern(pc.replace_substring(texts.filter(pc.invert(odd)), "\n", " \n"), " ")
    rest = pa.array([CUT.split(t) for t in texts.filter(odd).to_pylist()], pa.list_(texts.type))
    odd = odd.to_numpy(zero_copy_only=False)
    return [(np.flatnonzero(~odd), plain), (np.flatnonzero(odd), rest)]


def _gather(pool: np.ndarray, starts: np.ndarray, sizes: np.ndarray, room: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(numbers, ends) of the slices of `pool` one after the other; each gets `room` places, its size if not given."""
    room = sizes if room is None else room
    ends = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(room, out=ends[1:])
    found = np.zeros(ends[-1], pool.dtype)
    for a in range(0, len(starts), STRETCH):
        few = slice(a, a + STRETCH)
        inner = np.arange(sizes[few].sum()) - np.repeat(np.cumsum(sizes[few]) - sizes[few], sizes[few])
        found[np.repeat(ends[:-1][few], sizes[few]) + inner] = pool[np.repeat(starts[few], sizes[few]) + inner]
    return found, ends


class Encoder:
    """Ids of texts as bytes. Pieces between blanks come from the tokenizer once and are remembered.

    What is known is three arrays: pieces, their ids one after the other, and where those of each end.
    """

    def __init__(self, path: str, dtype: str, cut: bool = True):
        self.path, self.dtype, self.cut = path, dtype, cut
        self.words, self.pool, self.ends = pa.array([], pa.string()), np.zeros(0, dtype), np.zeros(1, np.int64)
        # Ids of tokens that begin with a blank or line feed, in byte-level vocabularies U+0120 and U+010A.
        vocabulary = _tokenizer(path).get_vocab()
        self.begins = {lead: np.zeros(max(vocabulary.values()) + 1, bool) for lead in ("\u0120", "\u010a")}
        for token, number in vocabulary.items():
            if token[0] in self.begins:
                self.begins[token[0]][number] = True
        self.marks = np.concatenate(self._ids(list(MARKS))) if cut else np.zeros(0, dtype)
        if cut and len(self.marks) != len(MARKS):
            raise ValueError("not a byte-level tokenizer with an id for each mark: use cut=False")

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        found = _tokenizer(self.path).encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, self.dtype) for x in found]

    def _lines(self, pieces: list[str], lead: str, shown: str) -> tuple[list[np.ndarray], np.ndarray]:
        """Ids of pieces, each after a lead, some in a line, and their sizes; a piece starts where a token begins with the lead."""
        lines = [pieces[i : i + LINE] for i in range(0, len(pieces), LINE)]
        ids = self._ids(["".join([lead + p for p in line]) for line in lines])
        sizes = [np.diff(np.flatnonzero(self.begins[shown][x]), append=len(x)) for x in ids]
        if list(map(len, sizes)) != list(map(len, lines)):
            raise ValueError("not a byte-level tokenizer that parts texts at blanks: use cut=False")
        return ids, np.concatenate([*sizes, np.zeros(0, np.int64)])

    def _learn(self, new: pa.Array) -> pa.Array:
        """Add distinct new pieces; gives them in the order in which they are kept."""
        pieces = new.to_numpy(zero_copy_only=False).tolist()
        broken = [p for p in pieces if p[:1] == "\n"]
        single = [p for p in pieces if p[:1] != "\n" and " " not in p]
        rest = [p for p in pieces if p[:1] != "\n" and " " in p]
        last = self._ids([" " + p for p in rest])
        found = [self._lines(broken, "", "\u010a"), self._lines(single, " ", "\u0120")]
        found.append((last, np.fromiter(map(len, last), np.int64, len(last))))
        words = pa.array(broken + single + rest, new.type)
        self.words = pa.concat_arrays([self.words, words])
        self.pool = np.concatenate([self.pool, *(x for ids, _ in found for x in ids)])
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(np.concatenate([sizes for _, sizes in found]))])
        return words

    def _places(self, pieces: pa.Array) -> np.ndarray:
        """Where known pieces are; others are learnt. Beyond `REMEMBERED`, those not among `pieces` are forgotten."""
        at = pc.index_in(pieces, value_set=self.words)
        if at.null_count and len(self.words) > REMEMBERED:
            kept = np.unique(at.drop_null().to_numpy())
            self.words = self.words.take(pa.array(kept))
            self.pool, self.ends = _gather(self.pool, self.ends[kept], np.diff(self.ends)[kept])
            at = pc.index_in(pieces, value_set=self.words)
        known = len(self.words)
        missing = pieces.filter(at.is_null())
        places = at.fill_null(-1).to_numpy().astype(np.int64)
        if len(missing):
            places[places < 0] = known + pc.index_in(missing, value_set=self._learn(missing.unique())).to_numpy()
        return places

    def _put_together(self, pieces: pa.ListArray) -> list[bytes]:
        """Ids of texts from their pieces. Each distinct piece is looked up once, without a mark at its end."""
        coded = pieces.flatten().dictionary_encode()
        which = coded.indices.to_numpy()
        firsts = pieces.offsets.to_numpy()[:-1] - pieces.offsets[0].as_py()
        heads = self._ids(coded.dictionary.take(pa.array(which[firsts])).to_pylist())
        follows = np.ones(len(which), bool)
        follows[firsts] = False
        there = np.zeros(len(coded.dictionary), bool)
        there[which[follows]] = True
        distinct = coded.dictionary.filter(pa.array(there))
        marked = pc.match_substring_regex(distinct, MARKED)
        stems = pc.if_else(marked, pc.utf8_slice_codeunits(distinct, 0, -1), distinct)
        places = self._places(stems)
        marked = marked.to_numpy(zero_copy_only=False)
        starts, sizes = self.ends[places], np.diff(self.ends)[places]
        pool, ends = _gather(self.pool, starts, sizes, sizes + marked)
        marks = pc.utf8_slice_codeunits(distinct.filter(pa.array(marked)), -1)
        pool[ends[1:][marked] - 1] = self.marks[pc.index_in(marks, value_set=pa.array(list(MARKS))).to_numpy()]
        start, size = np.zeros((2, len(there)), np.int64)
        start[there], size[there] = ends[:-1], np.diff(ends)
        ids, ends = _gather(pool, start[which], np.where(follows, size[which], 0))
        bounds = ends[[*firsts, len(which)]].tolist()
        return [head.tobytes() + ids[a:b].tobytes() for head, a, b in zip(heads, bounds, bounds[1:])]

    def encode(self, texts: list[str] | pa.Array) -> list[bytes]:
        if not self.cut:
            return [ids.tobytes() for ids in self._ids([str(t) for t in texts])]
        texts = texts.cast(pa.string()) if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        found = [b""] * len(texts)
        for places, pieces in pieces_of(texts):
            if len(places):
                for place, ids in zip(places.tolist(), self._put_together(pieces)):
                    found[place] = ids
        return found


@lru_cache(maxsize=2)
def _encoder(path: str, dtype: str, cut: bool) -> Encoder:
    """One for all tasks of a worker."""
    return Encoder(path, dtype, cut)


def _together(batch: pa.RecordBatch):
    """Slices of a batch of about `TOGETHER` bytes of text; a longer text is in one by itself or the last."""
    sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy().astype(np.int64)
    group = np.cumsum(sizes) // TOGETHER
    starts = np.flatnonzero(np.diff(group, prepend=-1)).tolist()
    for a, b in zip(starts, [*starts[1:], len(batch)]):
        yield batch.slice(a, b - a)


def token_blocks(
    docs: DataFrame,
    tokenizer: str,
    vocabulary: int = 50_257,
    doc_id: str = "doc_id",
    text: str = "text",
    block_ids: int = BLOCK_IDS,
    cut: bool = True,
) -> DataFrame:
    """Blocks of the ids of all documents in ascending doc_id order, ready to be written.

    `tokenizer` is the path of a tokenizers file that all executors can read. Null texts are empty;
    each document ends in id 0. Documents without an id come first; rows that share an id follow
    each other by text, all of them. An empty table gives no blocks. Texts are range partitioned once,
    in parts that the session's settings and adaptive execution choose by size; then a task encodes and packs what it has as a stream, so memory holds one block. `cut=False`
    encodes texts in one piece, for tokenizers other than byte-level BPE.
    """
    dtype = "<u2" if vocabulary <= 1 << 16 else "<u4"
    width = np.dtype(dtype).itemsize
    end = np.array([END_ID], dtype).tobytes()

    def pack(batches):
        encoder = _encoder(tokenizer, dtype, cut)
        part, block, start = TaskContext.get().partitionId(), 0, 0
        names, held, size = [], [], 0

        def flush():
            ends = np.cumsum(np.fromiter(map(len, held), np.int64, len(held))) // width
            code = EliasFano.encode(ends)
            row = [part, block, start, len(held), int(ends[-1]), width, b"".join(held)]
            row += [code.low_bits, code.low, code.high, code.selects]
            unnamed, first, named = encode_names(names)
            row += [unnamed, first, named.low_bits, named.low, named.high, named.selects]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
            kinds += [pa.int32(), pa.binary(), pa.binary(), pa.binary()]
            kinds += [pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
            fields = [field.split()[0] for field in BLOCKS.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], fields)

        for batch in batches:
            for few in _together(batch):
                ids = encoder.encode(pc.fill_null(few.column("text"), ""))
                for name, one in zip(few.column("doc_id").to_pylist(), ids):
                    if held and size + len(one) // width + 1 > block_ids:
                        yield flush()
                        block, start = block + 1, start + size
                        names, held, size = [], [], 0
                    names.append(name)
                    held.append(one + end)
                    size += len(one) // width + 1
        if held:
            yield flush()

    ordered = (
        docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "text")
    )
    return ordered.mapInArrow(pack, BLOCKS)


def write_tokens(docs: DataFrame, path: str, tokenizer: str, **options) -> None:
    """Write the blocks of `docs` as a new folder."""
    token_blocks(docs, tokenizer, **options).write.parquet(path)


def directory(blocks: DataFrame) -> DataFrame:
    """(part, first): ids of all parts before. One row per part; ids themselves are not read."""
    parts = blocks.groupBy("part").agg(F.sum("n_ids").alias("ids"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return parts.select("part", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("first"))


def block_boundaries(row) -> EliasFano:
    """The boundaries of one block: offset i is where its document i ends."""
    return EliasFano(row["n_docs"], row["low_bits"], bytes(row["low"]), bytes(row["high"]), bytes(row["selects"]))


def block_names(row) -> list[int | None]:
    """The doc_ids of one block, in order."""
    n = row["n_docs"] - row["n_unnamed"]
    code = EliasFano(n, row["id_low_bits"], bytes(row["id_low"]), bytes(row["id_high"]), bytes(row["id_selects"]))
    return [None] * row["n_unnamed"] + ((code.decode() + row["first_id"]).tolist() if n else [])


NAMES = ["part", "block", "n_docs", "n_unnamed", "first_id", "id_low_bits", "id_low", "id_high", "id_selects"]
BOUNDS = ["n_docs", "low_bits", "low", "high", "selects"]


def read_documents(spark: SparkSession, path: str, wanted: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, ids) of the wanted documents, end id included, without reading the other documents' ids out.

    Which block has a document, and at what place, comes from the blocks' names alone; then each place is looked up in
    its block by select. Rows that share an id all come; ids that are asked for twice count once, null or unknown ids
    give nothing.
    """
    blocks = spark.read.schema(BLOCKS).parquet(path)

    def name(batches):
        for batch in batches:
            for row in batch.to_pylist():
                found = block_names(row)[row["n_unnamed"] :]
                places = np.arange(row["n_unnamed"], row["n_docs"], dtype=np.int32)
                columns = [pa.array([row[k]] * len(found), pa.int32()) for k in ("part", "block")]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(found, pa.int64()), pa.array(places)], ["part", "block", "doc_id", "place"])

    def fetch(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ends, ids = block_boundaries(row), np.frombuffer(row["ids"], f"<u{row['width']}")
                found = [(w["doc_id"], ids[ends[w["place"] - 1] if w["place"] else 0 : ends[w["place"]]]) for w in row["asked"]]
                names, slices = zip(*found)
                columns = [pa.array(names, pa.int64()), pa.array([s.astype(np.int64) for s in slices], pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids"])

    named = blocks.select(*NAMES).mapInArrow(name, "part int, block int, doc_id long, place int")
    asked = named.join(wanted.select(F.col(doc_id).cast("long").alias("doc_id")).distinct(), "doc_id")
    # At most the documents of a block.
    asked = asked.groupBy("part", "block").agg(F.collect_list(F.struct("doc_id", "place")).alias("asked"))
    held = blocks.select("part", "block", "width", "ids", *BOUNDS).join(asked, ["part", "block"])
    return held.mapInArrow(fetch, "doc_id long, ids array<bigint>")


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """What the files hold of each document: doc_id, start, n_tokens (with the end id), ids_crc32.

    `start` counts the ids of all documents before it; the checksum is that of its ids as unsigned
    little-endian 32-bit integers.
    """
    blocks = spark.read.schema(BLOCKS).parquet(path)

    def entries(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ends = block_boundaries(row).decode()
                starts = np.concatenate(([0], ends[:-1]))
                ids = np.frombuffer(row["ids"], f"<u{row['width']}").astype("<u4")
                sums = [zlib.crc32(ids[a:b]) for a, b in zip(starts.tolist(), ends.tolist())]
                columns = [
                    pa.array([row["part"]] * len(ends), pa.int32()),
                    pa.array(block_names(row), pa.int64()),
                    pa.array(starts + row["start"], pa.int64()),
                    pa.array(ends - starts, pa.int64()),
                    pa.array(sums, pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in ENTRIES.split(", ")])

    found = blocks.mapInArrow(entries, ENTRIES)
    # The directory has a row per part, however many documents there are.
    placed = found.join(F.broadcast(directory(blocks)), "part")
    return placed.select("doc_id", (F.col("first") + F.col("start")).alias("start"), "n_tokens", "ids_crc32")
