"""Byte-level BPE: encoding with offsets by the tokenizers library, decoding by the byte table."""

from __future__ import annotations

import hashlib
import json
import os
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.kernels import LETTER, SPACE, char_classes

CACHED_PIECES = 500_000  # pieces in one generation of a worker's memory; two generations are kept
CACHED_CHARS = 48  # longer pieces are not remembered
STEP = 1 << 20  # code points handled at once, so memory does not follow the text


def byte_alphabet() -> dict[str, int]:
    """Printable stand-ins of the 256 bytes: printable Latin-1 stands for itself, the rest follows from U+0100 on."""
    plain = [b for b in range(256) if chr(b).isprintable() and b != 0x20]
    table = {chr(b): b for b in plain}
    rest = [b for b in range(256) if b not in set(plain)]
    return table | {chr(256 + i): b for i, b in enumerate(rest)}


def piece_starts(points: np.ndarray) -> np.ndarray:
    """Where the pieces that never merge begin, for the code points of a text.

    A piece is a run of one class. Of white space before another class the last character stands apart, and joins
    the piece behind it if it is a blank. An apostrophe that begins a piece takes s, t, m, d, re, ve or ll with it.
    """
    n = len(points)
    kind = char_classes()[points]
    start = np.ones(n, dtype=bool)
    start[1:] = kind[1:] != kind[:-1]
    blank = kind == SPACE
    last = np.flatnonzero(blank[:-1] & ~blank[1:])
    start[last] = True
    start[last[points[last] == 0x20] + 1] = False
    quote = np.flatnonzero((points[:-1] == 0x27) & start[:-1] & (kind[1:] == LETTER))
    if len(quote):
        one = points[quote + 1]
        two = np.where(quote + 2 < n, points[np.minimum(quote + 2, n - 1)], 0)
        single = np.isin(one, [ord(c) for c in "stmd"])
        double = ((np.isin(one, [ord("r"), ord("v")]) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l"))))
        for found, width in ((quote[single], 2), (quote[double], 3)):
            start[found + 1] = False
            behind = found[found + width < n] + width
            start[behind] = True
    return np.flatnonzero(start)


class Codec:
    """Encoder and decoder of one byte-level vocabulary file."""

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one worker per core already
        from tokenizers import Tokenizer, pre_tokenizers

        self.model = Tokenizer.from_file(vocabulary)
        self.model.encode_special_tokens = True  # their strings are ordinary text
        # pieces come cut and mapped to the byte alphabet already
        self.model.pre_tokenizer = pre_tokenizers.Sequence([])
        with open(vocabulary, encoding="utf-8") as f:
            ids = json.load(f)["model"]["vocab"]
        letters = byte_alphabet()
        self.letter_of = {b: c for c, b in letters.items()}
        size = max(ids.values()) + 1
        self.bytes_of: list[bytes] = [b""] * size
        for token, i in ids.items():
            if all(c in letters for c in token):
                self.bytes_of[i] = bytes(letters[c] for c in token)
        self.names = [str(i) for i in range(size)]
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _ids(self, pieces: list[str]) -> np.ndarray:
        """Ids of the pieces one after the other; those not met lately are encoded together."""
        if len(self.known) > CACHED_PIECES:
            self.older, self.known = self.known, {}
        long, new = {}, []
        for p in set(pieces).difference(self.known):
            if p in self.older:
                self.known[p] = self.older[p]
            else:
                new.append(p)
        mapped = [p.encode().decode("latin-1").translate(self.letter_of) for p in new]
        for p, e in zip(new, self.model.encode_batch_fast(mapped, add_special_tokens=False)):
            (self.known if len(p) <= CACHED_CHARS else long)[p] = np.array(e.ids, dtype=np.int32).tobytes()
        table = self.known | long if long else self.known
        return np.frombuffer(b"".join(map(table.__getitem__, pieces)), dtype=np.int32)

    def steps(self, text: str):
        """Arrays of ids, a bounded number of code points at a time."""
        at, width = 0, STEP
        while at < len(text):
            part = text[at : at + width]
            cut = piece_starts(np.frombuffer(part.encode("utf-32-le"), dtype=np.uint32)).tolist()
            cut.append(len(part))
            if at + width < len(text):
                # what ends near the edge may look different with the rest of the text behind it
                while len(cut) > 1 and cut[-1] > len(part) - 4:
                    cut.pop()
                if len(cut) == 1:
                    width *= 2
                    continue
            yield self._ids([part[a:b] for a, b in zip(cut, cut[1:])])
            at, width = at + cut[-1], STEP

    def encode(self, text: str) -> np.ndarray:
        found = list(self.steps(text))
        return np.concatenate(found) if found else np.zeros(0, dtype=np.int32)

    def decode(self, ids) -> bytes:
        """The bytes of the ids. A character cut by a token boundary is whole again once the bytes are joined."""
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def offsets(self, text: str, ids) -> tuple[list[int], list[int]]:
        """First and last (exclusive) code point that each token touches; tokens that share a character overlap."""
        lengths = np.fromiter((len(self.bytes_of[i]) for i in ids), dtype=np.int64, count=len(ids))
        if not len(lengths):
            return [], []
        data = np.frombuffer(text.encode(), dtype=np.uint8)
        char_of = np.cumsum((data & 0xC0) != 0x80) - 1  # the code point that each byte belongs to
        end = np.cumsum(lengths)
        return char_of[end - lengths].tolist(), (char_of[end - 1] + 1).tolist()


@lru_cache(maxsize=4)
def codec(vocabulary: str) -> Codec:
    return Codec(vocabulary)


def encode(docs: DataFrame, vocabulary: str) -> DataFrame:
    """`docs` plus `ids`, `starts` and `ends`: token ids and the code points each token touches (end exclusive).

    Null and empty texts have no tokens. No special tokens are added, and their strings count as ordinary text.
    Existing columns of these names are replaced.
    """
    plain = docs.drop("ids", "starts", "ends")
    source = plain.select(F.struct(*[F.col(f"`{c}`") for c in plain.columns]).alias("row"), F.col("text").alias("text"))
    schema = f"row {source.schema['row'].dataType.simpleString()}, ids array<int>, starts array<int>, ends array<int>"

    def run(batches):
        c = codec(vocabulary)
        for b in batches:
            texts = [t or "" for t in b.column("text").to_pylist()]
            ids = [c.encode(t) for t in texts]
            spans = [c.offsets(t, i) for t, i in zip(texts, ids)]
            kind = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays(
                [b.column("row"), pa.array(ids, kind), pa.array([s for s, _ in spans], kind),
                 pa.array([e for _, e in spans], kind)],
                names=["row", "ids", "starts", "ends"],
            )

    return source.mapInArrow(run, schema).select("row.*", "ids", "starts", "ends")


def decode(tokens: DataFrame, vocabulary: str, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """`tokens` plus the decoded bytes in `name`; null ids give null, an id outside the vocabulary nothing."""

    @F.pandas_udf("binary")
    def run(column):
        c = codec(vocabulary)
        size = len(c.bytes_of)
        return column.map(lambda x: None if x is None else c.decode([i for i in x if 0 <= i < size]))

    return tokens.withColumn(name, run(F.col(ids)))


def round_trip(docs: DataFrame, vocabulary: str) -> DataFrame:
    """`(doc_id, n_tokens, ids_sha256, decoded_sha256)`: each text encoded, its ids decoded, both as digests.

    Ids are written in decimal with one space between them. A text is handled about a million code points at a time,
    so a text of any length needs little memory. Null counts as empty.
    """

    def run(batches):
        c = codec(vocabulary)
        for b in batches:
            counts, coded, back = [], [], []
            for text in b.column("text").to_pylist():
                n, h, d = 0, hashlib.sha256(), hashlib.sha256()
                for ids in c.steps(text or ""):
                    h.update(((" " if n else "") + " ".join(map(c.names.__getitem__, ids.tolist()))).encode())
                    d.update(c.decode(ids.tolist()))
                    n += len(ids)
                counts.append(n)
                coded.append(h.hexdigest())
                back.append(d.hexdigest())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(counts, pa.int64()), pa.array(coded), pa.array(back)],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(
        run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
