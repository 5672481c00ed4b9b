"""Byte pair encoding as a streaming transducer with bounded lookahead, and decoding as a state machine."""

from __future__ import annotations

import codecs
import hashlib
import heapq
import json
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from quakeframe.llm.common import map_rows

WORDS, CHUNKS = 200_000, 100_000  # words and chunks that a worker remembers, in each of two generations
_NEVER = 1 << 60
# The pattern by which byte-level tokenizers that name none split a text: a fixed value of their file format.
BYTE_LEVEL_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_alphabet() -> list[str]:
    """The character for each byte: printable bytes stand for themselves, others follow from 256 on."""
    shown = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    hidden = iter(range(256, 512))
    return [chr(b if b in shown else next(hidden)) for b in range(256)]


class Remembered(dict):
    """A bounded memory of a function: two generations, of which the older one is dropped."""

    def __init__(self, function, size: int):
        super().__init__()
        self.function, self.size, self.old = function, size, {}

    def __missing__(self, key):
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        value = self.old.get(key)
        if value is None:
            value = self.function(key)
        self[key] = value
        return value


class Merges:
    """A merge list: its tables, its sufficient lookahead and the transducer over one word."""

    def __init__(self, vocab: dict[str, int], merges: list, suffix: str | None):
        self.ranks, self.made = {}, []
        length: dict[int, int] = {}
        alphabet = byte_alphabet()
        self.byte = [vocab.get(c, -1) for c in alphabet]
        self.last = [vocab.get(c + suffix, -1) for c in alphabet] if suffix else self.byte
        for one in (*self.byte, *self.last):
            length[one] = 1
        left: dict[int, int] = {}  # the first part of each token that a merge makes
        reach: dict[int, int] = {}  # by first part: how far left a change can have moved when such a merge is due
        self.lookahead = self.longest = 1
        for rank, pair in enumerate(merges):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            first, second, whole = vocab[a], vocab[b], vocab[a + b]
            if first not in length or second not in length or whole in length:
                raise ValueError("a merge must join tokens made before it into a new one")
            self.ranks[first, second] = rank
            self.made.append(whole)
            length[whole], left[whole] = length[first] + length[second], first
            spine, moved = second, reach.get(second, 0)
            while spine in left:
                spine = left[spine]
                moved = max(moved, reach.get(spine, 0))
            far = length[first] + moved
            reach[first] = max(reach.get(first, 0), far)
            self.lookahead, self.longest = max(self.lookahead, far), max(self.longest, length[whole])
        self.length = length
        self.window = 2 * self.lookahead + 2 * self.longest

    def merge(self, parts: list[int]) -> list[int]:
        """Applies the merges to symbols: always the earliest merge of the list, leftmost first."""
        if len(parts) > 48:
            return self._merge_many(parts)
        get, made = self.ranks.get, self.made
        due = [get(pair, _NEVER) for pair in zip(parts, parts[1:])]
        while due:
            rank = min(due)
            if rank == _NEVER:
                break
            i = due.index(rank)
            parts[i : i + 2] = [made[rank]]
            del due[i]
            if i < len(due):
                due[i] = get((parts[i], parts[i + 1]), _NEVER)
            if i:
                due[i - 1] = get((parts[i - 1], parts[i]), _NEVER)
        return parts

    def _merge_many(self, parts: list[int]) -> list[int]:
        """The same with a heap over linked symbols."""
        get, n = self.ranks.get, len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i) for i in range(n - 1) if (r := get((parts[i], parts[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i]
            if parts[i] < 0 or j >= n or get((parts[i], parts[j])) != rank:
                continue
            parts[i], parts[j], after[i] = self.made[rank], -1, after[j]
            if after[i] < n:
                before[after[i]] = i
                if (r := get((parts[i], parts[after[i]]))) is not None:
                    heapq.heappush(heap, (r, i))
            if before[i] >= 0 and (r := get((parts[before[i]], parts[i]))) is not None:
                heapq.heappush(heap, (r, before[i]))
        return [p for p in parts if p >= 0]

    def encode(self, data: Iterable[int]) -> Iterator[int]:
        """Tokens of one word from its bytes, each as soon as no further byte can change it.

        The window holds the bytes without a token so far. A token is stable when ``lookahead`` bytes
        follow it. Why so many are enough: run the merges over a text and over the same text with
        more bytes behind. Where both agree ends a prefix, which shrinks only when a merge (u, v)
        spans its end in one of the two runs, and then by the length of u. The next merge to do so is
        later in the list, and its second part begins with that u. So the prefix shrinks by the
        lengths along such a chain of merges at most, and ``lookahead`` is the longest chain.
        """
        if isinstance(data, bytes) and 0 < len(data) < self.window:  # the whole word fits
            own = self.byte
            window = [own[b] for b in data[:-1]]
            window.append(self.last[data[-1]])
            yield from self.merge(window)
            return
        window = []
        ahead = iter(data)
        byte = next(ahead, None)
        while byte is not None:
            following = next(ahead, None)
            window.append(self.last[byte] if following is None else self.byte[byte])
            if len(window) >= self.window and following is not None:
                done = 0
                for token in self.merge(list(window)):
                    if done + self.length[token] > len(window) - self.lookahead:
                        break
                    done += self.length[token]
                    yield token
                del window[:done]
            byte = following
        yield from self.merge(window)


class Codec:
    """A tokenizer file of the byte pair kind: encoder and decoder."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.vocab = dict(model["vocab"])
        self.merges = Merges(self.vocab, model["merges"], model.get("end_of_word_suffix") or None)
        added = {x["content"]: x["id"] for x in spec.get("added_tokens") or []}
        self.added = added
        self.special = regex.compile("|".join(regex.escape(x) for x in sorted(added, key=len, reverse=True))) if added else None
        self.token = {i: t for t, i in {**self.vocab, **added}.items()}
        norm = spec.get("normalizer")
        kinds = [n["type"] for n in (norm["normalizers"] if norm and norm["type"] == "Sequence" else [norm] if norm else [])]
        if unknown := {*kinds} - {"NFC", "Replace", "Lowercase"}:
            raise ValueError(f"normalizers {unknown} are not supported")
        self.nfc, self.lower, self.spaces = ("NFC" in kinds), ("Lowercase" in kinds), ("Replace" in kinds)
        pre = spec["pre_tokenizer"]
        split = next((p for p in (pre["pretokenizers"] if pre["type"] == "Sequence" else [pre]) if p["type"] == "Split"), None)
        pattern = split["pattern"]["Regex"] if split else BYTE_LEVEL_PATTERN
        self.pattern = regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))
        self.joined = spec.get("decoder") is None  # tokens as they are, with spaces between
        # Where white space is dropped, no token spans it, so chunks between white space are encoded alone.
        self.by_chunk = bool(split) and split["behavior"] == "Removed" and split["invert"]
        self.words = Remembered(self._word, WORDS)
        self.chunks = Remembered(self._chunk, CHUNKS)
        self.bytes = {c: b for b, c in enumerate(byte_alphabet())}

    def _normal(self, text: str) -> str:
        if text.isascii() and not _WHITE.search(text):
            return text.lower() if self.lower else text
        if self.nfc:
            text = unicodedata.normalize("NFC", text)
        if self.spaces:
            text = _SPACES.sub(" ", text)
        if self.lower:  # one character at a time: a sigma at a word's end is no special case
            text = text.lower() if "Σ" not in text else "".join(c.lower() for c in text)
        return text

    def _part(self, text: str) -> Iterator[int]:
        for found in self.pattern.finditer(self._normal(text)):
            yield from self.merges.encode(found.group().encode())

    def encode(self, text: str) -> Iterator[int]:
        """Ids of a text in order, without special tokens at its ends; those within it count as themselves."""
        at = 0
        for found in self.special.finditer(text) if self.special else ():
            yield from self._part(text[at : found.start()])
            yield self.added[found.group()]
            at = found.end()
        yield from self._part(text[at:] if at else text)

    def _word(self, word: str) -> tuple[int, str, str]:
        ids = list(self.merges.encode(word.encode()))
        return len(ids), " ".join(map(str, ids)), "".join(self.decode(ids))

    def _chunk(self, chunk: str) -> tuple[int, str, str]:
        """The same for a run without white space and special tokens, word by word."""
        words = self.words
        found = [words[w] if len(w) <= 64 else self._word(w) for w in self.pattern.findall(self._normal(chunk))]
        if len(found) == 1:
            return found[0]
        return sum([v[0] for v in found]), " ".join([v[1] for v in found]), " ".join([v[2] for v in found])

    def decode(self, ids: Iterable[int]) -> Iterator[str]:
        """Text of ids, piece by piece. The state is a separator, or the bytes of an unfinished character."""
        if self.joined:
            between = ""
            for i in ids:
                if i in self.token:
                    yield between + self.token[i]
                    between = " "
            return
        state = codecs.getincrementaldecoder("utf-8")(errors="replace")
        for i in ids:
            token = self.token.get(i, "")
            data = bytes(self.bytes[c] for c in token) if all(c in self.bytes for c in token) else token.encode()
            yield state.decode(data)
        yield state.decode(b"", final=True)

    def both(self, text: str) -> tuple[int, str, str]:
        """Number of ids, the ids as decimal numbers with spaces between, and the decoded text."""
        if not self.by_chunk or not self.joined or self.special and "<|" in text or _SEPARATORS.search(text):
            ids = list(self.encode(text))
            return len(ids), " ".join(map(str, ids)), "".join(self.decode(ids))
        chunks = self.chunks
        found = [v for v in ([chunks[c] if len(c) <= 64 else self._chunk(c) for c in text.split()]) if v[0]]
        return sum([v[0] for v in found]), " ".join([v[1] for v in found]), " ".join([v[2] for v in found])


_WHITE = regex.compile(r"\s")
_SPACES = regex.compile(r"\p{White_Space}+")
_SEPARATORS = regex.compile(r"[\x1c-\x1f]")  # white space to Python only
_CODECS: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """The codec of a file, made once in each process."""
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]


def _coded(docs: DataFrame, path: str, with_ids: bool) -> DataFrame:
    def rows(blocks):
        own = codec(path)
        for block in blocks:
            n, ids, digests, text = [], [], [], []
            for value in block["text"]:
                count, numbers, decoded = own.both(value.as_py() or "")
                n.append(count)
                if with_ids:
                    ids.append(np.array(numbers.split(), dtype=np.int32))
                digests.append(hashlib.sha256(numbers.encode()).hexdigest())
                text.append(hashlib.sha256(decoded.encode()).hexdigest())
            shown = [pa.array(ids, pa.list_(pa.int32()))] if with_ids else []
            yield block["doc_id"], pa.array(n, pa.int64()), *shown, digests, text

    chosen = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"])
    return map_rows(chosen, rows, "doc_id long, n_tokens long, " + "ids array<int>, " * with_ids + "ids_sha256 string, decoded_sha256 string")


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` for every row of ``docs``.

    ``path`` names a tokenizer file that all executors have. Defined cases: a null text is an empty
    one, with no ids; an empty decoded text has the digest of nothing; a null ``doc_id`` stays null;
    repeated rows are encoded each; a text without white space is one stream whose window is bounded;
    an empty table gives no rows; other columns are ignored.
    """
    return _coded(docs, path, False)


def tokenized(docs: DataFrame, path: str) -> DataFrame:
    """The same with the ids themselves."""
    return _coded(docs, path, True)
