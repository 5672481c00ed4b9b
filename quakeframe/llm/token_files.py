"""Token ids in files: every document compressed on its own with a shared dictionary, found by an index.

A file holds, in little-endian order: the magic, the SHA-256 of the dictionary, the bytes of one id
(2 or 4), a zstandard frame for each document, and the index (one ``ENTRY`` per document: its id, the
place of its frame, the ids before it in the file, its ids). The last ``TAIL`` bytes say where the
index begins, how many documents and ids there are, and repeat the magic. So one document is read
with two short reads and one frame.
"""

from __future__ import annotations

import hashlib
import io
import json
import re
import struct
import unicodedata
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quakeframe.llm.bpe import Remembered
from quakeframe.llm.common import id_bounds, map_rows, ordered_ranges, range_number, stored
from quakeframe.session import work_dir

MAGIC = b"TOKIDS01"
HEAD, TAIL = struct.Struct("<8s32sI"), struct.Struct("<QQQ8s")
ENTRY = np.dtype([("doc_id", "<i8"), ("null", "u1"), ("offset", "<u8"), ("size", "<u4"), ("start", "<u8"), ("n", "<u8")])
SAMPLE_DOCS = 2000  # documents, about, whose ids train the dictionary
SAMPLE_BYTES = 8 << 20  # and bytes of them at most
DICTIONARY_BYTES = 32 << 10
DOCS_PER_FILE = 50_000
LEAST = -(1 << 63)
WORDS, CHUNKS, LONGEST = 450_000, 700_000, 64  # words and chunks of so many characters at most that a worker remembers, in each of two generations
END_ID = 1


class Letters(dict):
    """The letters that the tokenizers library makes of a character, in the alphabet of the vocabulary, or ``OTHER``.

    Asked once for each character: one that stays a letter between letters is lower-cased and spelled on its own.
    """

    OTHER = "\n"

    def __init__(self, tokenizer: Tokenizer):
        super().__init__()
        self.tokenizer = tokenizer

    def __missing__(self, code: int) -> str:
        text = chr(code)
        if text.isascii():
            self[code] = text.lower()
        else:
            pieces = self.tokenizer.pre_tokenizer.pre_tokenize_str(f"x{self.tokenizer.normalizer.normalize_str(text)}x")
            word = pieces[0][0]
            own = len(pieces) == 1 and len(word) > 2 and word[0] == word[-1] == "x" and unicodedata.category(text).startswith("L")
            self[code] = word[1:-1] if own else self.OTHER
        return self[code]


class Shadow(dict):
    """As many ``x`` as ``letters`` has for a character; ASCII characters are their own."""

    def __init__(self, letters: Letters):
        super().__init__()
        self.letters = letters

    def __missing__(self, code: int) -> str:
        self[code] = self.letters[code] if code < 128 else "x" * len(self.letters[code])
        return self[code]


class Short(Remembered):
    """Remembers what has ``LONGEST`` characters at most and works out the rest each time."""

    def __missing__(self, key: str):
        return super().__missing__(key) if len(key) <= LONGEST else self.function(key)


class Encoder:
    """The tokenizers library, asked once for each word of a text as long as a bounded memory holds it."""

    def __init__(self, path: str, width: int):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.type = {2: "<u2", 4: "<u4"}[width]
        self.model = self.tokenizer.model
        self.code = {2: "H", 4: "I"}[width]
        self.chunks = Short(self._chunk, CHUNKS)
        self.words = Short(self._word, WORDS)
        spec = json.loads(self.tokenizer.to_str())
        norm, pre = spec["normalizer"] or {}, spec["pre_tokenizer"] or {}
        split = next((p for p in pre.get("pretokenizers", []) if p["type"] == "Split" and "Regex" in p["pattern"]), None)
        # Where white space is dropped before words are made, no token spans it.
        self.by_chunk = bool(split and split["behavior"] == "Removed" and split["invert"])
        # Of ASCII characters the normalizer only changes capitals here, and the pattern needs no tables.
        plain = [n["type"] for n in norm.get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]
        pattern = split["pattern"]["Regex"].replace(r"\p{L}", "a-zA-Z").replace(r"\p{N}", "0-9") if split else r"\p"
        self.ascii = re.compile(pattern, re.ASCII) if plain and r"\p" not in pattern else None
        self.letters = Letters(self.tokenizer)
        self.shadow = Shadow(self.letters)
        self.special = any(not t.content.startswith("<|") for t in self.tokenizer.get_added_tokens_decoder().values())

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=self.type).tobytes()

    def _word(self, word: str) -> bytes:
        ids = [t.id for t in self.model.tokenize(word)]
        return struct.pack(f"<{len(ids)}{self.code}", *ids)

    def _chunk(self, chunk: str) -> bytes:
        words, pieces = self.words, self._pieces(chunk)
        return words[pieces[0]] if len(pieces) == 1 else b"".join([words[w] for w in pieces])

    def _pieces(self, chunk: str) -> list[str]:
        if self.ascii and chunk.isprintable():  # control characters have names of their own in the vocabulary
            if chunk.isascii():
                return [chunk.lower()] if chunk.isalpha() else self.ascii.findall(chunk.lower())
            spelled = chunk.translate(self.letters)
            if Letters.OTHER not in spelled and unicodedata.is_normalized("NFC", chunk):
                if chunk.isalpha():
                    return [spelled]
                return [spelled[m.start() : m.end()] for m in self.ascii.finditer(chunk.translate(self.shadow))]
        return self._asked(chunk)

    def _asked(self, chunk: str) -> list[str]:
        return [w for w, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(self.tokenizer.normalizer.normalize_str(chunk))]

    def encode(self, text: str) -> bytes:
        """The ids of a text as an array in bytes."""
        if not self.by_chunk or self.special or "<|" in text or any(c in text for c in "\x1c\x1d\x1e\x1f"):
            return self._whole(text)
        return b"".join(map(self.chunks.__getitem__, text.split()))


_ENCODERS: dict[tuple, Encoder] = {}


def encoder(path: str, width: int) -> Encoder:
    if (path, width) not in _ENCODERS:
        _ENCODERS[path, width] = Encoder(path, width)
    return _ENCODERS[path, width]


def id_width(path: str) -> int:
    return 2 if Tokenizer.from_file(path).get_vocab_size() <= 1 << 16 else 4


def train_dictionary(docs: DataFrame, path: str, width: int) -> bytes:
    """A dictionary from the id arrays of a bounded sample, chosen by a hash of the text; empty if they are too few."""
    rows = docs.count()
    share = min(1.0, SAMPLE_DOCS / max(1, rows))
    sample = docs.where(F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < F.lit(int(share * (1 << 20)))).select("text")

    def ids(blocks):
        own = encoder(path, width)
        for block in blocks:
            yield ([own.encode(t.as_py() or "")[: SAMPLE_BYTES // SAMPLE_DOCS] for t in block["text"]],)

    samples = [bytes(r["ids"]) for r in map_rows(sample, ids, "ids binary").limit(2 * SAMPLE_DOCS).collect()]
    samples = sorted(s for s in samples if len(s) >= 8)
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):  # the library wants some hundred samples
        return b""


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    return zstandard.ZstdCompressor(level=3, dict_data=shared, write_dict_id=False)


def _decompressor(dictionary: bytes) -> zstandard.ZstdDecompressor:
    return zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)


def _filesystem(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


def _write_file(path: str, rows: Iterator[tuple], digest: bytes, width: int) -> tuple[int, int, int]:
    """Writes frames as they come and the index behind them; the file takes its name when it is whole."""
    system, to = _filesystem(path)
    system.create_dir(to.rpartition("/")[0], recursive=True)
    part, entries, start = f"{to}.{uuid.uuid4().hex}.part", [], 0
    with system.open_output_stream(part) as out:
        out.write(HEAD.pack(MAGIC, digest, width))
        at = HEAD.size
        for doc_id, n, frame in rows:
            out.write(frame)
            entries.append((doc_id or 0, doc_id is None, at, len(frame), start, n))
            at, start = at + len(frame), start + n
        out.write(np.array(entries, dtype=ENTRY).tobytes())
        out.write(TAIL.pack(at, len(entries), start, MAGIC))
        size = at + len(entries) * ENTRY.itemsize + TAIL.size
    system.move(part, to)
    return len(entries), start, size


def _index(file, digest: bytes) -> tuple[np.ndarray, int]:
    """The index of an open file and the bytes of one id. The dictionary must be the one it was written with."""
    magic, written, width = HEAD.unpack(file.read(HEAD.size))
    size = file.size()
    file.seek(size - TAIL.size)
    at, docs, _, again = TAIL.unpack(file.read(TAIL.size))
    if magic != MAGIC or again != MAGIC:
        raise ValueError("not a whole file of token ids")
    if written != digest:
        raise ValueError("the file was written with another dictionary")
    file.seek(at)
    return np.frombuffer(file.read(docs * ENTRY.itemsize), dtype=ENTRY), width


def fetch(path: str, dictionary: bytes, doc_id: int) -> np.ndarray | None:
    """The ids of one document, read by the index; nothing else is decompressed."""
    system, at = _filesystem(path)
    with system.open_input_file(at) as file:
        index, width = _index(file, hashlib.sha256(dictionary).digest())
        found = np.flatnonzero((index["doc_id"] == doc_id) & (index["null"] == 0))
        if not len(found):
            return None
        entry = index[found[0]]
        file.seek(int(entry["offset"]))
        data = _decompressor(dictionary).stream_reader(io.BytesIO(file.read(int(entry["size"])))).read()
        return np.frombuffer(data, dtype=f"<u{width}")


def _keep_dictionary(root: str, dictionary: bytes) -> None:
    """Puts the dictionary beside the files, under its hash."""
    system, at = _filesystem(root)
    system.create_dir(at, recursive=True)
    with system.open_output_stream(f"{at}/{hashlib.sha256(dictionary).hexdigest()}.dict") as out:
        out.write(dictionary)


def write(docs: DataFrame, path: str, root: str, end_id: int = END_ID) -> tuple[DataFrame, bytes]:
    """Encodes ``docs`` and writes one file for each range of ids under ``root``. Returns the list of files
    (``file, path, docs, ids, bytes``, in ascending order of ids) and the dictionary.

    Ranges come from quantiles of the ids, so a file holds neighbours and all files together are in
    ascending order. Texts become frames before the shuffle, which moves compressed ids only. A task
    that runs again writes the same file again.
    """
    spark = docs.sparkSession
    width = id_width(path)
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    dictionary = train_dictionary(chosen, path, width)
    digest = hashlib.sha256(dictionary).digest()
    _keep_dictionary(root, dictionary)
    key = F.coalesce("doc_id", F.lit(LEAST))
    bounds = id_bounds(chosen, key, ordered_ranges(spark, chosen.count(), DOCS_PER_FILE))

    def frames(blocks):
        own, pack = encoder(path, width), _compressor(dictionary)
        end = end_id.to_bytes(width, "little")
        for block in blocks:
            data = [own.encode(t.as_py() or "") + end for t in block["text"]]
            yield block["doc_id"], pa.array([len(d) // width for d in data], pa.int64()), [pack.compress(d) for d in data]

    def files(blocks):
        def docs_of(first: dict) -> Iterator[tuple]:
            nonlocal rest
            number = first["file"][0]
            block, at = first, 0
            while block is not None:
                for at in range(at, len(block["file"])):
                    if block["file"][at] != number:
                        rest = (block, at)
                        return
                    yield block["doc_id"][at].as_py(), block["n"][at].as_py(), block["frame"][at].as_py()
                block, at = next(blocks, None), 0
            rest = None

        rest = next(blocks, None)
        rest = rest and (rest, 0)
        while rest:
            block, at = rest
            first = {k: v.slice(at) for k, v in block.items()}
            number = first["file"][0].as_py()
            name = f"{root}/ids-{number:06d}.bin"
            n, ids, size = _write_file(name, docs_of(first), digest, width)
            yield [number], [name], [n], [ids], [size]

    encoded = map_rows(chosen, frames, "doc_id long, n long, frame binary")
    # The number of ids stands in for a tie between rows of one id, then the frame itself.
    encoded = encoded.withColumn("file", (range_number(key, bounds) - 1).cast("int"))
    ordered = encoded.repartitionById(max(1, len(bounds)), "file").sortWithinPartitions("file", key, "n", "frame")
    return stored(map_rows(ordered, files, "file int, path string, docs long, ids long, bytes long"), "token-files"), dictionary


def read(files: DataFrame, dictionary: bytes) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32, file`` of every document, from the files.

    ``start`` counts the ids of all documents before it: those before it in its file, from the index,
    and those of the files before, from the list of files (one row per file).
    """
    digest = hashlib.sha256(dictionary).digest()
    before = F.coalesce(F.sum("ids").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    listed = files.select("file", "path", before.alias("before"))

    def rows(blocks):
        unpack = _decompressor(dictionary)
        for block in blocks:
            for number, name, ahead in zip(*(block[k].to_pylist() for k in ("file", "path", "before"))):
                system, at = _filesystem(name)
                with system.open_input_file(at) as file:
                    index, width = _index(file, digest)
                    for low in range(0, len(index), 1024):
                        part = index[low : low + 1024]
                        file.seek(int(part["offset"][0]))
                        begin, data = int(part["offset"][0]), file.read(int(part["offset"][-1] + part["size"][-1] - part["offset"][0]))
                        crc = []
                        for offset, size, n in zip(part["offset"].tolist(), part["size"].tolist(), part["n"].tolist()):
                            ids = np.frombuffer(unpack.decompress(data[offset - begin : offset - begin + size], max_output_size=n * width), dtype=f"<u{width}")
                            if len(ids) != n:
                                raise ValueError(f"{name}: a document has {len(ids)} ids, its index {n}")
                            crc.append(zlib.crc32(ids.astype("<u4").tobytes()))
                        ids = pa.array(part["doc_id"], mask=part["null"].astype(bool))
                        yield ids, pa.array(part["start"].astype("i8") + ahead), pa.array(part["n"].astype("i8")), crc, [number] * len(part)

    spread = listed.repartition(files.sparkSession.sparkContext.defaultParallelism, "file")
    return map_rows(spread, rows, "doc_id long, start long, n_tokens long, ids_crc32 long, file int")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """Writes ``docs`` to a folder of the shared one and reads the files back.

    Defined cases: a null text is an empty one and has the end id only; rows with a null ``doc_id``
    come first; of rows that repeat an id, the one with fewer ids comes first; an empty table gives no
    files and no rows; a text of any length is one frame; other columns are ignored.
    """
    return read(*write(docs, path, work_dir(docs.sparkSession, "token-ids")))
