"""Token ids of documents in binary files, Simple-8b coded.

A file is a run of segments, each followed by one line feed. A segment holds, in
little-endian 64-bit numbers: magic, documents, ids, blocks, words; then the document
ids, the number of ids of each document, the block offsets (one more than blocks) and
the words. Documents stand in ascending id order through a file and from file to file.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fareway.llm import simple8b
from fareway.llm.common import id_and_text, in_small_batches, map_rows, unkey
from fareway.session import materialize

MAGIC = 0x31423853
#: Pieces, and ids of pieces, a worker remembers before it forgets those not met of late.
_REMEMBERED, _REMEMBERED_IDS = 350_000, 3_000_000
_SEGMENT_IDS = 500_000
_CHUNK_CHARS = 1_000_000
#: Marks that form pieces of their own; apostrophes and angle brackets have rules of their own.
_MARKS = '!"#$%&()*+,-./:;=?@[\\]^_`{|}~'
_GAP, _LETTERS, _MARK, _OTHER = range(4)


def _byte_kinds(letters: bytes, marks: bytes) -> bytes:
    kinds = bytearray([_OTHER] * 256)
    for kind, members in ((_GAP, b" \n"), (_LETTERS, letters), (_MARK, marks)):
        for b in members:
            kinds[b] = kind
    return bytes(kinds)


_UPPER, _LOWER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"
_KINDS, _KINDS_UNCUT = _byte_kinds(_UPPER + _LOWER, _MARKS.encode()), _byte_kinds(b"", b"")
_LOWERED = bytes.maketrans(_UPPER, _LOWER)
#: The first byte of letters from U+00C0 to U+00FF in UTF-8, which second bytes make one, and which an upper-case one.
_LATIN = 0xC3
_LATIN_LETTERS = np.array([0x80 <= b < 0xC0 and chr(b + 0x40).isalpha() for b in range(256)])
_LATIN_UPPER = np.array([0x80 <= b < 0xC0 and chr(b + 0x40).isupper() for b in range(256)])


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of runs that begin at ``starts``, one run after the other."""
    ends = np.cumsum(sizes, dtype=np.int64)
    return np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)


class WordIds:
    """Ids of texts; each distinct piece goes through the tokenizer once.

    A run between spaces or line feeds is cut into its runs of Latin letters, in lower
    case, and of marks; with anything else in it, it is one piece as it stands. Exact for
    tokenizers whose tokens never reach over a space, a line feed or such a cut and that
    drop white space, as checked at the start.
    """

    def __init__(self, tokenizer_file: str, end_id: int):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        if self._encode("a \n b") != self._encode("a") + self._encode("b"):
            raise ValueError("the tokenizer keeps white space")
        lower = self._encode("ABC ÀÞ xÉy") == self._encode("abc àþ xéy")
        cuts = [("ab", m, "cdé", m) for m in (*_MARKS, "$$$", "?!", "...", _MARKS)]
        # else runs between spaces are pieces as they stand
        self.cut = lower and all(self._encode("".join(c)) == [i for part in c for i in self._encode(part)] for c in cuts)
        self.bytes = self._byte_letters() if lower else None
        self.end_id = end_id
        self.index = _Index()
        self.starts = np.zeros(0, np.int64)
        self.lengths = np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint32)
        self.last = np.zeros(0, np.int64)

    def _encode(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _byte_letters(self) -> dict[int, str] | None:
        """How the model spells lower-case Latin-1 letters, if words of them may go to the model itself."""
        from tokenizers.pre_tokenizers import ByteLevel

        spell = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        letters = [chr(i) for i in range(256) if chr(i).isalpha() and chr(i).lower() == chr(i)]
        table = {ord(c): spell(c)[0][0] for c in letters}
        for word in ("thequickbrownfoxjumpsoverthelazydog", *letters, "".join(letters), "".join(reversed(letters))):
            if [t.id for t in self.tokenizer.model.tokenize(word.translate(table))] != self._encode(word):
                return None
        return table

    def _learn(self) -> None:
        """Ids of the new pieces: words of lower-case Latin-1 letters go to the model itself, others to the tokenizer."""
        if not self.index.new:
            return
        flat, lengths = [], []
        tokenize, table = self.tokenizer.model.tokenize, self.bytes
        # no piece holds a line feed
        for word in b"\n".join(self.index.new).decode().split("\n"):
            if table is None or not (word.isalpha() and word.islower()):
                ids = self._encode(word)
            elif word.isascii():
                ids = [t.id for t in tokenize(word)]
            else:
                ids = [t.id for t in tokenize(word.translate(table))] if ord(max(word)) < 256 else self._encode(word)
            flat += ids
            lengths.append(len(ids))
        self.index.new.clear()
        self.starts = np.r_[self.starts, len(self.flat) + np.cumsum(lengths, dtype=np.int64) - lengths]
        self.lengths = np.r_[self.lengths, np.array(lengths, np.int64)]
        self.flat = np.r_[self.flat, np.array(flat, np.uint32)]

    def _keep(self, at: np.ndarray) -> None:
        """Forget all pieces but those numbered ``at``."""
        pieces = list(self.index)
        self.flat, self.lengths = self._gather(at)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.index = _Index((pieces[i], n) for n, i in enumerate(at.tolist()))

    def rest(self) -> None:
        """Between tasks a worker remembers the pieces of its last texts alone."""
        self._keep(self.last)
        self.last = np.arange(len(self.index))

    def _gather(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of indexed pieces in a row, and how many each has."""
        lengths = self.lengths[at]
        return self.flat[_ranges(self.starts[at], lengths)], lengths

    def _pieces(self, text: bytearray) -> tuple[pa.Array, np.ndarray]:
        """The pieces of UTF-8 text in a row, and the place where each begins."""
        data, low = np.frombuffer(text, np.uint8), text
        kinds = np.frombuffer(text.translate(_KINDS if self.cut else _KINDS_UNCUT), np.uint8)
        if self.cut:
            low = np.frombuffer(text.translate(_LOWERED), np.uint8)
            latin = np.flatnonzero(data == _LATIN)
            latin = latin[_LATIN_LETTERS[data[latin + 1]]]
            kinds[latin] = kinds[latin + 1] = _LETTERS
            low[latin + 1] += _LATIN_UPPER[data[latin + 1]] * np.uint8(0x20)
        starts = np.r_[np.arange(min(len(data), 1)), np.flatnonzero(kinds[1:] != kinds[:-1]) + 1]
        sizes, kind = np.diff(starts, append=len(data)), kinds[starts]
        others = np.flatnonzero(kind == _OTHER) if self.cut else []
        if len(others):
            gaps = np.r_[-1, np.flatnonzero(kind == _GAP), len(kind)]
            run = np.searchsorted(gaps, others)
            run = run[np.r_[True, run[1:] != run[:-1]]]
            first, parts = gaps[run - 1] + 1, gaps[run] - gaps[run - 1] - 1
            sizes[first] = np.add.reduceat(sizes[_ranges(first, parts)], np.cumsum(parts) - parts)
            here = _ranges(starts[first], sizes[first])
            low[here] = data[here]
            kind[_ranges(first + 1, parts - 1)] = _GAP
        mine = kind != _GAP
        offsets = np.r_[0, np.cumsum(sizes[mine])]
        packed = bytes(low).translate(None, b" \n")
        pieces = pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(packed)])
        return pieces, starts[mine]

    def texts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, each closed by the end id, and how many each has."""
        coded = [text.encode() for text in texts]
        pieces, starts = self._pieces(bytearray(b"\n".join(coded)))
        pieces = pieces.dictionary_encode()
        distinct = pieces.dictionary.to_numpy(zero_copy_only=False).tolist()
        at = np.fromiter(map(self.index.__getitem__, distinct), np.int64, len(distinct))
        self._learn()
        ids, lengths = self._gather(at[pieces.indices.to_numpy().astype(np.int64)])
        if len(self.index) > _REMEMBERED or len(self.flat) > _REMEMBERED_IDS:
            self._keep(at if len(at) <= _REMEMBERED // 2 else at[:0])
            at = np.arange(len(self.index))
        self.last = at
        ends = np.cumsum([len(text) + 1 for text in coded])
        borders = np.r_[0, np.cumsum(lengths)][np.searchsorted(starts, ends)]
        return np.insert(ids, borders, self.end_id), np.diff(np.r_[0, borders]) + 1


class _Index(dict):
    """Number of each piece in order of appearance; ``new`` lists those not tokenized yet."""

    def __init__(self, *known):
        super().__init__(*known)
        self.new: list[bytes] = []

    def __missing__(self, piece: bytes) -> int:
        n = self[piece] = len(self)
        self.new.append(piece)
        return n


def pack_segment(doc_ids: np.ndarray, lengths: np.ndarray, ids: np.ndarray) -> bytes:
    words, offsets = simple8b.encode(ids)
    head = np.array([MAGIC, len(doc_ids), len(ids), len(offsets) - 1, len(words)], "<u8")
    return b"".join([head.tobytes(), doc_ids.astype("<i8").tobytes(), lengths.astype("<i8").tobytes(),
                     offsets.astype("<i8").tobytes(), words.astype("<u8").tobytes()])


def segments(content: bytes) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """doc ids, lengths and ids of each segment of a file."""
    at = 0
    while at < len(content):
        magic, docs, n, blocks, words = (int(x) for x in np.frombuffer(content, "<u8", 5, at))
        if magic != MAGIC:
            raise ValueError("no segment begins here")
        at += 40
        parts = []
        for count, kind in ((docs, "<i8"), (docs, "<i8"), (blocks + 1, "<i8"), (words, "<u8")):
            parts.append(np.frombuffer(content, kind, count, at))
            at += 8 * count
        doc_ids, lengths, offsets, packed = parts
        yield doc_ids, lengths, simple8b.decode(packed, offsets, n)
        at += 1


_TOKENIZERS: dict[tuple[str, int], WordIds] = {}


def _word_ids(tokenizer_file: str, end_id: int) -> WordIds:
    """One for all tasks of a worker; a task's own function gets a copy of each module variable it names."""
    key = (tokenizer_file, end_id)
    if key not in _TOKENIZERS:
        _TOKENIZERS[key] = WordIds(*key)
    return _TOKENIZERS[key]


def write_token_ids(docs: DataFrame, path: str, tokenizer_file: str, end_id: int, partitions: int | None = None) -> None:
    """Write the ids of every whole text, in ascending id order, to files below ``path``.

    Rows are range-partitioned by id (``partitions``, or the session's shuffle width) and
    sorted by id and text; a file holds at most eight segments of about half a million ids,
    however large its partition. Null texts are empty: only the end id. Null ids come
    first, as the smallest number; repeated rows are written as often as they occur. The
    write goes through Spark's committer, so a lost executor's tasks leave nothing behind.
    """
    spark = docs.sparkSession
    width = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def run(batches):
        tokenizer = _word_ids(tokenizer_file, end_id)
        held: list[tuple] = []
        size = 0
        for batch in batches:
            for doc_ids, texts in _chunks(batch):
                ids, lengths = tokenizer.texts(texts)
                held.append((doc_ids, lengths, ids))
                size += len(ids)
                if size >= _SEGMENT_IDS:
                    yield {"segment": [pack_segment(*map(np.concatenate, zip(*held, strict=True)))]}
                    held, size = [], 0
        if held:
            yield {"segment": [pack_segment(*map(np.concatenate, zip(*held, strict=True)))]}
        tokenizer.rest()

    rows = id_and_text(docs).repartitionByRange(width, "doc_id").sortWithinPartitions("doc_id", "text")
    packed = map_rows(rows, "segment binary", run)
    # the text writer copies a string's bytes as they are
    with in_small_batches(spark):
        packed.select(F.col("segment").cast("string")).write.option("maxRecordsPerFile", 8).text(path)


def _chunks(batch):
    doc_ids, texts, size = [], [], 0
    for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
        doc_ids.append(doc_id)
        texts.append(text.as_py())
        size += len(texts[-1])
        if size >= _CHUNK_CHARS:
            yield np.array(doc_ids, np.int64), texts
            doc_ids, texts, size = [], [], 0
    if texts:
        yield np.array(doc_ids, np.int64), texts


def read_token_ids(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document in the files below ``path``.

    start counts the ids of all documents before. The order of files follows the
    partition and file number in their names; one row a file finds the starts.
    """

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                content = batch["content"][i].as_py()
                part, piece, before = batch["part"][i].as_py(), batch["piece"][i].as_py(), 0
                for doc_ids, lengths, ids in segments(content):
                    ends = np.cumsum(lengths)
                    data = memoryview(ids.astype("<u4").tobytes())
                    crcs = [zlib.crc32(data[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), lengths.tolist(), strict=True)]
                    yield {
                        "part": [part] * len(doc_ids), "piece": [piece] * len(doc_ids), "doc_id": doc_ids,
                        "start": before + ends - lengths, "n_tokens": lengths, "ids_crc32": crcs,
                    }
                    before += int(lengths.sum())

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    name = F.col("path")
    files = files.select(
        F.regexp_extract(name, r"part-(\d+)[^/]*$", 1).cast("long").alias("part"),
        F.regexp_extract(name, r"-c(\d+)[^/]*$", 1).cast("long").alias("piece"),
        "content",
    )
    schema = "part long, piece long, doc_id long, start long, n_tokens long, ids_crc32 long"
    with in_small_batches(spark):
        rows = materialize(map_rows(files, schema, run), "token-rows")
    totals = rows.groupBy("part", "piece").agg(F.sum("n_tokens").alias("total"))
    before = F.sum("total").over(Window.orderBy("part", "piece").rowsBetween(Window.unboundedPreceding, -1))
    bases = totals.select("part", "piece", F.coalesce(before, F.lit(0)).alias("base"))
    return rows.join(bases, ["part", "piece"]).select(
        unkey().alias("doc_id"), (F.col("start") + F.col("base")).alias("start"), "n_tokens", "ids_crc32"
    )
