"""Byte-pair encoding by dynamic programming over prefixes, and decoding.

For each prefix of a word exactly one token can end its encoding. An automaton
over the vocabulary lists, for each prefix, the tokens that are its suffixes;
the right one is the token that is compatible with the last token of the
remaining shorter prefix. Following the stored tokens back from the end gives
the ids that merging by rank would give, in one pass and without a merge queue.

Texts: null counts as empty, any length; a text is encoded whole. Repeated rows
are encoded each; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Iterator
from functools import cached_property

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from haplometh.llm.arrow import frugal

#: Fixed values of byte-level vocabularies: how a text is split before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: A space before more white space: only there may white space run on across a space.
RUNNING = [" " + c for c in map(chr, range(0x3001)) if c.isspace()]
#: A word of Latin letters with ASCII punctuation behind it: split as the pattern would.
PUNCTUATED = re.compile(r"([A-Za-zÀ-ÖØ-öø-ɏ]+)([!-/:-@\[-`{-~]+)")
CACHED_PIECES = 400_000
CACHED_PAIRS = 1_000_000
LONGEST_CACHED = 48


def byte_letters() -> dict[str, int]:
    """The printable letter that byte-level vocabularies write for each byte."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    letters = {chr(b): b for b in plain}
    rest = [b for b in range(256) if b not in set(plain)]
    return letters | {chr(256 + i): b for i, b in enumerate(rest)}


class Codec:
    """Encoder and decoder of one vocabulary file, given as its JSON text."""

    def __init__(self, source: str):
        told = json.loads(source)
        model, letters = told["model"], byte_letters()
        self.special = {t["content"]: t["id"] for t in told["added_tokens"]}
        for t in told["added_tokens"]:
            if t["lstrip"] or t["rstrip"] or t["single_word"]:
                raise ValueError(f"unsupported added token {t['content']!r}")
        ids = model["vocab"]
        self.vocabulary: dict[int, bytes] = {i: bytes(letters[c] for c in token) for token, i in ids.items() if token not in self.special}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.rank = {(ids[a], ids[b]): r for r, (a, b) in enumerate(pairs)}
        self.parts = {ids[a + b]: (ids[a], ids[b], r) for r, (a, b) in enumerate(pairs)}
        self.pieces: dict[str, bytes] = {}  # ids of 32 bits, half the size of tuples
        self.tails: dict[str, bytes] = {}
        self.compatible: dict[int, bool] = {}

    @cached_property
    def automaton(self) -> ahocorasick.Automaton:
        found = ahocorasick.Automaton()
        for i, token in self.vocabulary.items():
            if i < 256 or i in self.parts:
                found.add_word(token.decode("latin-1"), (i, len(token)))
        found.make_automaton()
        return found

    @cached_property
    def split_special(self):
        return re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None

    def fits(self, left: int, right: int) -> bool:
        """Whether merging would leave ``left`` and ``right`` beside each other.

        Undo the merges of both, latest first. At each stage the two tokens at
        the border stand side by side until the next undone merge takes one
        away; had they a merge of an earlier rank, it would have come first. Of
        equal ranks the one further left is merged first.
        """
        known = self.compatible.get(left << 32 | right)
        if known is not None:
            return known
        x, y, until = left, right, len(self.rank)
        answer = True
        while True:
            if self.rank.get((x, y), until) < until:
                answer = False
                break
            made_x, made_y = (self.parts[t][2] if t in self.parts else -1 for t in (x, y))
            if made_x < 0 and made_y < 0:
                break
            if made_x > made_y:
                until, x = made_x, self.parts[x][1]
            else:  # right parts made by the same merge as the left ones are made later
                until, y = made_y + 1, self.parts[y][0]
        if len(self.compatible) >= CACHED_PAIRS:
            self.compatible.clear()
        self.compatible[left << 32 | right] = answer
        return answer

    def word(self, raw: bytes) -> list[int]:
        """Ids of one pre-split word."""
        last: list[int] = [0] * len(raw)
        back: list[int] = [0] * len(raw)
        known, fits = self.compatible.get, self.fits
        done = -1
        for end, (token, size) in self.automaton.iter(raw.decode("latin-1")):
            if end != done:
                if size <= end:
                    before = last[end - size]
                    fit = known(before << 32 | token)
                    if fit is None:
                        fit = fits(before, token)
                    if not fit:
                        continue
                last[end], back[end], done = token, size, end
        found, at = [], len(raw) - 1
        while at >= 0:
            found.append(last[at])
            at -= back[at]
        return found[::-1]

    @cached_property
    def words(self):
        return regex.compile(PATTERN).findall

    def whole(self, text: str) -> bytes:
        return array("i", [i for w in self.words(text) for i in self.word(w.encode())]).tobytes()

    def piece(self, piece: str) -> bytes:
        """Ids of ``piece`` with a space before it."""
        if parts := PUNCTUATED.fullmatch(piece):
            letters, tail = parts.groups()
            return (self.pieces.get(letters) or self.piece(letters)) + self.tail(tail)
        found = self.whole(" " + piece)
        if len(piece) <= LONGEST_CACHED:
            if len(self.pieces) >= CACHED_PIECES:
                self.pieces.clear()
            self.pieces[piece] = found
        return found

    def tail(self, marks: str) -> bytes:
        found = self.tails.get(marks)
        if found is None:
            found = array("i", self.word(marks.encode())).tobytes()
            if len(marks) <= LONGEST_CACHED and len(self.tails) < CACHED_PAIRS:
                self.tails[marks] = found
        return found

    def plain(self, text: str) -> bytes:
        """The ids of a text without special tokens.

        The pre-split never joins a space to what stands before it unless white
        space runs on, so a text falls apart at its spaces and each piece is
        looked up; texts with running white space are split whole.
        """
        if text[-1:] == " " or any(map(text.__contains__, RUNNING)):
            return self.whole(text)
        first, *rest = text.split(" ")
        known = self.pieces.get
        return b"".join([self.whole(first), *[known(p) or self.piece(p) for p in rest]])

    def encode(self, text: str) -> list[int]:
        ids = array("i")
        if self.split_special is None or not any(s in text for s in self.special):
            ids.frombytes(self.plain(text))
            return ids.tolist()
        for part in self.split_special.split(text):
            if part in self.special:
                ids.append(self.special[part])
            elif part:
                ids.frombytes(self.plain(part))
        return ids.tolist()

    @cached_property
    def spelled(self) -> dict[int, bytes]:
        return self.vocabulary | {i: s.encode() for s, i in self.special.items()}

    @cached_property
    def decimal(self) -> dict[int, str]:
        return {i: str(i) for i in self.spelled}

    def decode(self, ids) -> str:
        return b"".join(map(self.spelled.__getitem__, ids)).decode("utf-8", "replace")


def codec(source: str) -> Codec:
    """A codec for one task: what it has cached goes when the task ends, and does not stay in an idle worker."""
    return Codec(source)


def encode(docs: DataFrame, path: str, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep``, ``n_tokens``, ``ids`` and digests of the ids and of their decoded text.

    ``path`` is a byte-level vocabulary file; the driver reads it and every task
    gets its text (a fixed size). The decoded text comes from the ids alone.
    """
    told = docs.sparkSession.sparkContext.broadcast(open(path, encoding="utf-8").read())
    kept = docs.select(*keep).schema
    names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(told.value)
        for whole in batches:
            for batch in (whole.slice(i, 512) for i in range(0, whole.num_rows, 512)):
                counts, all_ids, sums, backs = [], [], [], []
                for text in batch.column("__text").to_pylist():
                    ids = c.encode(text or "")
                    counts.append(len(ids))
                    all_ids.append(pa.array(ids, pa.int32()))
                    sums.append(hashlib.sha256(",".join(map(c.decimal.__getitem__, ids)).encode()).hexdigest())
                    backs.append(hashlib.sha256(c.decode(ids).encode()).hexdigest())
                offsets = pa.array([0, *_running(counts)], pa.int32())
                lists = pa.ListArray.from_arrays(offsets, pa.concat_arrays(all_ids))
                columns = [batch.column(i) for i in range(batch.num_columns - 1)]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(counts, pa.int64()), lists, pa.array(sums), pa.array(backs)],
                    names=[*keep, "n_tokens", "ids", "ids_sha256", "decoded_sha256"],
                )

    source = docs.select(*keep, docs["text"].alias("__text"))
    return source.mapInArrow(frugal(run), f"{names}, n_tokens long, ids array<int>, ids_sha256 string, decoded_sha256 string")


def _running(counts: list[int]) -> list[int]:
    total, out = 0, []
    for n in counts:
        total += n
        out.append(total)
    return out


def decode(encoded: DataFrame, path: str, ids: str = "ids", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` and ``text``, decoded from a column of ids (null ids: null text)."""
    told = encoded.sparkSession.sparkContext.broadcast(open(path, encoding="utf-8").read())
    names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.select(*keep).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(told.value)
        for batch in batches:
            texts = [None if x is None else c.decode(x) for x in batch.column("__ids").to_pylist()]
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string())], names=[*keep, "text"])

    return encoded.select(*keep, encoded[ids].alias("__ids")).mapInArrow(frugal(run), f"{names}, text string")
