"""Packing of token sequences: tokenise, cut what is too long, and put the pieces into fixed-size sequences.

Tokens: a text's white-space chunks are tokenised one by one, each distinct chunk once for as long as it is in a
worker's table of chunks. The tokenizer splits at white space and drops it, so this gives the ids of the whole text.
A null text counts as an empty one; every document ends with the end id. Rows with null or repeated ids are packed
like any other; columns besides id and text are not looked at.

Packing: bounded-space online best-fit. Each partition keeps at most BINS open sequences in a bitset keyed by
free space: bit f is set if an open sequence has f free places. A piece goes to the open sequence with the least
free space that still takes it, the lowest set bit at or above its length. If none takes it, a new one is opened;
where BINS are open already, the fullest closes first. Pieces meet a partition in hashed order, which mixes long
and short ones. A piece that fills a sequence takes one for itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import Scratch

CAPACITY = 4096
END = 1
BINS = 256
#: Pieces of a partition: what stays open at its end is little against this many.
PIECES = 1 << 15
#: Distinct chunks that a worker remembers, and the longest of them in bytes.
CHUNKS, LONGEST = 500_000, 48
#: Lower-case letters below this are single precomposed letters: the tokenizer's normalisation leaves them as they are.
PLAIN = "\u0250"


class ChunkTokenizer(dict):
    """Ids of white-space chunks by the word-end BPE, as little-endian 32-bit numbers; looks up what it has met."""

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        # The byte alphabet: bytes that print stand for themselves, the others for letters from U+0100 on.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = iter(range(256, 512))
        self.alphabet = {b: b if b in shown else next(hidden) for b in range(256)}
        assert set(map(chr, self.alphabet.values())) == set(pre_tokenizers.ByteLevel.alphabet())

    def __missing__(self, chunk: bytes) -> bytes:
        import array

        text = chunk.decode("utf-8", "replace")
        word = text[:-1] if len(chunk) > 1 and chunk[-1] in b".," else text
        low = word.lower()
        if low.isalpha() and max(low) < PLAIN:  # one run of letters, in lower case
            plain = low.encode()
            if plain != chunk:
                ids = self[plain] + (self[chunk[-1:]] if word is not text else b"")
            else:  # it goes to the merges as it is
                ids = array.array("I", [t.id for t in self.model.tokenize(plain.decode("latin-1").translate(self.alphabet))]).tobytes()
        else:
            ids = array.array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        if len(chunk) <= LONGEST:
            self[chunk] = ids
        return ids

    def ids(self, text: bytes) -> bytes:
        if len(self) > CHUNKS:
            self.clear()
        return b"".join(map(self.__getitem__, text.split()))


def pieces(df: DataFrame, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """(id, piece, start, length, ids_crc32): every document's pieces of at most `capacity` tokens.
    with_ids: also `ids`, the tokens. tokenizer: a path that executors can read; by default the public word-end BPE."""

    def run(batches):
        import struct
        import zlib

        import pyarrow as pa

        import public_tokenizers

        tok = ChunkTokenizer(tokenizer or public_tokenizers.path("word_bpe_49k.json"))
        end = struct.pack("<I", END)
        for b in batches:
            rows: list[tuple] = []
            for i, text in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist()):
                ids = memoryview(tok.ids(text or b"") + end)
                for n, at in enumerate(range(0, len(ids), 4 * capacity)):
                    own = ids[at : at + 4 * capacity]
                    rows.append((i, n, at // 4, len(own) // 4, zlib.crc32(own)) + ((list(own.cast("I")),) if with_ids else ()))
            cols = [pa.array(c, t) for c, t in zip(zip(*rows), types)] if rows else [pa.array([], t) for t in types]
            yield pa.RecordBatch.from_arrays(cols, names)

    import pyarrow as pa

    names = ["id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()] + [pa.list_(pa.int64())] * with_ids
    schema = f"id long, piece int, start long, length long, ids_crc32 long{', ids array<long>' * with_ids}"
    rows = df.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


class BestFit:
    """Open sequences in a bitset keyed by free space. place() gives (sequence, offset)."""

    def __init__(self, capacity: int, bins: int):
        self.capacity, self.bins = capacity, bins
        self.free, self.at, self.open, self.made = 0, {}, 0, 0

    def place(self, length: int) -> tuple[int, int]:
        fits = self.free >> length
        if fits and length < self.capacity:
            room = length + (fits & -fits).bit_length() - 1
            bin_ = self.take(room)
        else:
            room, bin_ = self.capacity, self.made
            self.made += 1
            if length < room and self.open == self.bins:
                self.take((self.free & -self.free).bit_length() - 1)  # the fullest closes
        if room > length:
            self.at.setdefault(room - length, []).append(bin_)
            self.free |= 1 << (room - length)
            self.open += 1
        return bin_, self.capacity - room

    def take(self, room: int) -> int:
        here = self.at[room]
        bin_ = here.pop()
        if not here:
            del self.at[room]
            self.free ^= 1 << room
        self.open -= 1
        return bin_


def pack(df: DataFrame, length_col: str = "length", capacity: int = CAPACITY, bins: int = BINS) -> DataFrame:
    """The rows of `df` with sequence_id and offset. Lengths are 1 to `capacity`. df: a written table, for it is
    counted and then read; the number of partitions follows from its rows. Input columns sequence_id and offset are replaced."""
    df = df.drop("sequence_id", "offset")
    names = df.columns

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        first = TaskContext.get().partitionId() << 40
        fit = BestFit(capacity, bins)
        for b in batches:
            spots = [fit.place(n) for n in b.column(names.index(length_col)).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array([first + s for s, _ in spots], pa.int64()), pa.array([o for _, o in spots], pa.int64())],
                [*names, "sequence_id", "offset"],
            )

    parts = max(1, round(df.count() / PIECES))
    # Dealt in turn: even parts for any keys. Blocks arrive as they are fetched, so each part is put into one order, by hash, and a task that runs
    # again places its pieces alike.
    plain = [c for c, t in df.dtypes if not t.startswith(("map", "variant"))]
    schema = df.withColumn("sequence_id", F.lit(0).cast("long")).withColumn("offset", F.lit(0).cast("long")).schema
    return df.repartition(parts).sortWithinPartitions(F.xxhash64(*plain), *(c for c, t in df.dtypes if not t.startswith(("map", "variant", "array", "struct")))).mapInArrow(run, schema)


def packed(df: DataFrame, **options) -> DataFrame:
    """Documents to placed pieces."""
    return pack(Scratch(df.sparkSession, "packing").save(pieces(df, **options), "pieces"))
