"""Packing by power-of-two decomposition.

A document's tokens are cut into pieces of binary length: as many of the longest as fit, then one for each bit of the
rest. Every piece is a sequence of its own, so no sequence crosses documents and none is padded; sequences of equal
length form a bucket from which batches of a fixed number of tokens are drawn.

A null or empty text has the end token alone. Rows are packed one by one, so repeated ids or rows give pieces of their
own; a null id stays null. Other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardmill.llm.common import give_back, tidied

#: Units whose ids a worker remembers: the last so many, and as many before these.
REMEMBERED = 300_000
#: New units are encoded together, with a sign between them that is a token of its own and in no other unit.
TOGETHER, BETWEEN = 512, "\x01"
#: Bytes of text encoded at once, and bits of a remembered place for the number of ids there.
SLICE, LENGTH_BITS = 1 << 20, 24
# How the public word vocabulary cuts a text, and how it marks the last piece of a part.
PARTS = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
PART_END = "</w>"
SPACE, LETTER, SIGN, KEPT = range(4)


class Memory:
    """Units and where their ids are in one array."""

    def __init__(self):
        self.places: dict[bytes, int] = {}
        self.ids = np.zeros(1 << 16, "<u4")
        self.used = 0

    def add(self, units: list[bytes], lengths: np.ndarray, ids: np.ndarray) -> None:
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[self.used : self.used + len(ids)] = ids
        starts = self.used + np.cumsum(lengths) - lengths
        self.places.update(zip(units, ((starts << LENGTH_BITS) | lengths).tolist(), strict=True))
        self.used += len(ids)


def gathered(ids: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The runs of ``ids`` at ``starts`` with ``lengths``, joined."""
    ends = np.cumsum(lengths)
    return ids[np.repeat(starts - ends + lengths, lengths) + np.arange(ends[-1] if len(ends) else 0)]


class Encoder:
    """Token ids of whole texts.

    The vocabulary's rules drop white space and never join across it, so a text's ids are those of its words in
    turn. Where the vocabulary lower-cases and parts letters from signs, as the public one does, a word of plain ASCII is cut into
    its runs of letters, lower-cased, and of other characters; a word with anything that the rules or the special tokens
    might treat as a whole (other characters, an apostrophe, a special token's first character) is a unit as it is. A
    slice of texts looks up its distinct units only; a unit's ids are remembered, over the tasks of a worker, until as
    many others have come since it was last seen.
    """

    held: dict[str, Encoder] = {}

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.between = self.tokenizer.encode(BETWEEN, add_special_tokens=False).ids
        self.memory, self.before = Memory(), Memory()
        with open(path, encoding="utf-8") as f:
            rules = json.load(f)
        steps = [x.get("type") for x in (rules.get("normalizer") or {}).get("normalizers", [])]
        splits = [x.get("pattern", {}).get("Regex") for x in (rules.get("pre_tokenizer") or {}).get("pretokenizers", [])]
        self.parts = "Lowercase" in steps and PARTS in splits and rules["model"].get("end_of_word_suffix") == PART_END
        self.classes = np.full(256, KEPT, np.uint8)
        self.classes[list(b" \t\n\r\x0b\x0c")] = SPACE
        if self.parts:
            self.classes[33:127] = SIGN
            for first in (b"a", b"A"):
                self.classes[first[0] : first[0] + 26] = LETTER
            for c in ["'", BETWEEN, *(x["content"][:1] for x in rules.get("added_tokens", []))]:
                self.classes[list(c.encode())] = KEPT
            vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
            self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
            self.ends[[i for t, i in vocabulary.items() if t.endswith(PART_END)]] = True

    @classmethod
    def of(cls, path: str) -> Encoder:
        if path not in cls.held:
            cls.held[path] = cls(path)
        return cls.held[path]

    def units(self, data: np.ndarray, starts: np.ndarray) -> tuple[pa.Array, np.ndarray]:
        """(units of all texts in turn, number of units before each text) of texts that lie one after another."""
        kind = self.classes[data]
        solid = kind != SPACE
        word = solid.copy()
        word[1:] &= ~solid[:-1]
        begins = starts[starts < len(data)]
        word[begins] = solid[begins]  # a new text is a new word
        unit = word
        low = data
        if self.parts:
            fresh = np.empty(len(data), bool)
            fresh[:1] = True
            np.not_equal(kind[1:], kind[:-1], out=fresh[1:])
            cut = np.ones(len(data), bool)
            held = kind == KEPT
            if held.any():
                of_word = np.cumsum(word, dtype=np.int32)
                kept = np.zeros(int(of_word[-1]) + 1, bool)
                kept[of_word[held]] = True
                cut = ~kept[of_word]
            unit = word | (solid & fresh & cut)
            low = data + (cut & (kind == LETTER) & (data < 97)).astype(np.uint8) * np.uint8(32)
        places = np.flatnonzero(unit)
        offsets = np.append(np.flatnonzero(unit[solid]), np.count_nonzero(solid)).astype(np.int32)
        found = pa.Array.from_buffers(pa.binary(), len(places), [None, pa.py_buffer(offsets), pa.py_buffer(low[solid])])
        return found, np.searchsorted(places, starts)

    def learn(self, units: list[bytes]) -> None:
        plain = [u for u in units if self.parts and u.isalpha()]
        if plain:
            # a run of ASCII letters is one part, and a part's last piece is marked: no sign between is needed
            joined = [" ".join([u.decode() for u in plain[i : i + TOGETHER]]) for i in range(0, len(plain), TOGETHER)]
            for i, found in enumerate(self.tokenizer.encode_batch_fast(joined, add_special_tokens=False)):
                part, ids = plain[i * TOGETHER : (i + 1) * TOGETHER], np.array(found.ids, "<u4")
                ends = np.flatnonzero(self.ends[ids])
                if len(ends) == len(part):
                    self.memory.add(part, np.diff(ends, prepend=-1), ids)
        rest = [u for u in units if u not in self.memory.places]
        for u in [u for u in rest if BETWEEN.encode() in u or len(self.between) != 1]:
            ids = np.array(self.tokenizer.encode(u.decode(), add_special_tokens=False).ids, "<u4")
            self.memory.add([u], np.array([len(ids)]), ids)
        rest = [u for u in rest if u not in self.memory.places]
        parts = [rest[i : i + TOGETHER] for i in range(0, len(rest), TOGETHER)]
        joined = [f" {BETWEEN} ".join([u.decode() for u in p]) for p in parts]
        for part, found in zip(parts, self.tokenizer.encode_batch_fast(joined, add_special_tokens=False), strict=True):
            ids = np.array(found.ids, "<u4")
            own = ids != self.between[0]
            ends = np.append(np.flatnonzero(~own), len(ids))
            self.memory.add(part, np.diff(ends, prepend=-1) - 1, ids[own])

    def known(self, units: list[bytes]) -> np.ndarray:
        """The places of the units in the memory, after learning those that are new."""
        if len(self.memory.places) > REMEMBERED:
            self.memory, self.before = Memory(), self.memory
        places = self.memory.places
        new = [u for u in units if u not in places]
        again = [u for u in new if u in self.before.places]
        if again:
            there = np.fromiter(map(self.before.places.__getitem__, again), np.int64, len(again))
            lengths = there & ((1 << LENGTH_BITS) - 1)
            self.memory.add(again, lengths, gathered(self.before.ids, there >> LENGTH_BITS, lengths))
            new = [u for u in new if u not in places]
        if new:
            self.learn(new)
        return np.fromiter(map(self.memory.places.__getitem__, units), np.int64, len(units))

    def __call__(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts joined, number of ids of each)."""
        data = np.frombuffer(b"".join(texts), np.uint8)
        starts = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        units, before = self.units(data, starts)
        encoded = units.dictionary_encode()
        places = self.known(binaries(encoded.dictionary))
        lengths = places & ((1 << LENGTH_BITS) - 1)
        ids = gathered(self.memory.ids, places >> LENGTH_BITS, lengths)
        # the distinct units' ids as lists, taken once per occurrence
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)), pa.array(ids))
        taken = lists.take(encoded.indices)
        ends = taken.offsets.to_numpy()
        return taken.flatten().to_numpy(), np.diff(ends[before].astype(np.int64))


def binaries(values: pa.Array) -> list[bytes]:
    """The values of a binary array without nulls, sliced out of its buffer at once."""
    offsets = np.frombuffer(values.buffers()[1], np.int32)[values.offset : values.offset + len(values) + 1].tolist()
    data = values.buffers()[2].to_pybytes() if values.buffers()[2] is not None else b""
    return [data[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]


def cut(total: int, longest: int) -> list[int]:
    """Lengths of the pieces of ``total`` tokens, in order."""
    whole, rest = divmod(total, longest)
    return [longest] * whole + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def pieces(docs: DataFrame, vocabulary: str | None = None, end_id: int = 2, longest: int = 4096) -> DataFrame:
    """doc_id, start, length, ids (binary, little-endian unsigned 32-bit), doc_tokens, sequence_id, offset, bucket.

    ``vocabulary``: path of a tokenizer file that each executor can read; the public word vocabulary if not given.
    ``longest``: a power of two. sequence_id is unique; bucket is the binary logarithm of the length.
    """
    if longest & (longest - 1):
        raise ValueError("longest must be a power of two")
    path = vocabulary or public_tokenizers.path("word_bpe_49k.json")
    end = np.array([end_id], "<u4").tobytes()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder.of(path)
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
            first = 0
            while first < batch.num_rows:
                last = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + SLICE, "right")))
                ids, counts = encode([t.as_py() or b"" for t in texts.slice(first, last - first)])
                row, start, length, total, data, at = [], [], [], [], [], 0
                for i, n in enumerate((counts + 1).tolist()):
                    tokens, done = ids[at : at + n - 1].tobytes() + end, 0
                    at += n - 1
                    for k in cut(n, longest):
                        row.append(first + i)
                        start.append(done)
                        length.append(k)
                        total.append(n)
                        data.append(tokens[4 * done : 4 * (done + k)])
                        done += k
                yield pa.record_batch(
                    [batch.column(0).take(pa.array(row, pa.int64())), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(data, pa.binary()), pa.array(total, pa.int64())],
                    names=["doc_id", "start", "length", "ids", "doc_tokens"],
                )
                first = last
            give_back()

    cutted = docs.select("doc_id", "text").mapInArrow(tidied(work), "doc_id long, start long, length long, ids binary, doc_tokens long")
    return cutted.select(
        "*",
        F.monotonically_increasing_id().alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
        F.log2("length").cast("int").alias("bucket"),
    )


def piece_digests(docs: DataFrame) -> DataFrame:
    """The pieces with a checksum in place of their ids."""
    p = pieces(docs)
    return p.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "bucket")
