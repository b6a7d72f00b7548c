"""Personal data in texts: exact patterns, and what a word-shape CRF adds to them.

The base finds e-mail addresses, IP addresses, payment cards and international
phone numbers by pattern. A linear-chain CRF over word shapes, trained from a
small labelled table, adds numbers written otherwise (phones without a plus,
cards with dots, IPv6). Its items are the words with a digit or an at sign; all
others are outside any span by constraint, so a text falls apart at them into
runs that Viterbi decodes exactly: short ones many at a time, long ones (tables
of numbers) by pieces that hand on their scores and back pointers.

Null or empty texts have no spans. Spans count code points, end exclusive;
repeated rows are each searched; other columns are ignored. An added span never
touches a base span.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from haplometh.llm.arrow import frugal
from haplometh.llm.crf import Group, Model, emissions, train, viterbi, viterbi_pieces

KINDS = ("email", "ip", "card", "phone")
#: The tails of the base patterns. Heads are found by their rarest letter.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGITS = re.compile(r"[0-9]")

Span = tuple[int, int, int]  # kind, start, end


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches from left to right; a match starts at the first local letter after the last one."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            free = found.end()
        at = text.find("@", max(at + 1, free))


def base_spans(text: str) -> list[Span]:
    found: list[Span] = [(0, *x) for x in emails(text)]
    if not DIGITS.search(text):
        return found
    if "." in text:
        for m in IP.finditer(text):
            parts = [p.lstrip("0") for p in m[0].split(".")]
            if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
                found.append((1, *m.span()))
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            found.append((2, *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(DIGITS.findall(m[0])) <= 15:
                found.append((3, *m.span()))
    return found


# The labelled table.

LABELS = ("O", "B-ip", "I-ip", "B-card", "I-card", "B-phone", "I-phone")
_OF = {"ip": 1, "card": 2, "phone": 3}
LABELLED_SCHEMA = "sentence_id long, words array<string>, labels array<string>"
#: Sentence frames and how values are written; d stands for a digit, h for a hexadecimal one.
FRAMES = ("call {} today", "tel {}", "phone: {} or write", "reach me at {}, thanks", "the number is {}.", "{}", "via {} only", "and {} was seen there", "sur {} pour", "de {} und die", "from {} to")
VALUES = {
    "phone": ("(ddd) ddd-dddd", "ddd-ddd-dddd", "ddd.ddd.dddd", "ddd ddd dddd", "+d (ddd) ddd-dddd", "+dd ddd ddddddd", "00dd ddd ddddddd", "(ddd)ddd-dddd", "0ddd-ddddddd"),
    "card": ("dddd.dddd.dddd.dddd", "dddd dddd dddd dddd", "dddd-dddd-dddd-dddd", "dddd/dddd/dddd/dddd"),
    "ip": ("dddd:hhh::h", "dddd:hhh:hhhh::hh", "hhhh:hhhh:hhhh:hhhh:hhhh:hhhh:hhhh:hhhh", "[dddd:hhh::h]", "fe80::hhhh:hhh"),
}
OTHER = ("d.d", "d.d.d", "version d.d", "dddd", "dd", "d", "dddd-dd-dd", "dd:dd", "dd:dd:dd", "dd/dd/dddd", "$d,ddd.dd", "dd%", "dd%%%", "ddd!!", "d-d", "dd-dd", "dd.dd.dddd", "ddd pages", "dddd dddd", "ddd ddd", "ddddddd", "dddddddddd", "dddddddddddddddd", "hhhhhhhhhhhhhhhhhhhh", "ddd-d-dd-dddddd-d", "xdd@x.org", "@xxdd", "(dd)", "(dddd)", "d, d and d", "dd.d", "d.ddd.ddd", "ddd ddd ddd ddd ddd", "dddd dddd dddd", "dd dd dd dd dd", "xxdddd", "#ddd", "ddxd", "password=hhhhhhhhhhhhhhhhhh", "key=hhhhhhhhhhhhhhhhhh", "token = \"hhhhhhhhhhhhhhhhhhhh\"", "x.dd@mailx.example.com", "ddd.dd.ddd.dd")
#: Values side by side, one after the other.
BESIDE = ((("phone", "+d (ddd) ddd-dddd"), ("card", "dddddddddddddddd")), (("card", "dddddddddddddddd"), ("phone", "+d (ddd) ddd-dddd")), (("", "x.dd@mailx.example.com"), ("phone", "+d (ddd) ddd-dddd")))


def _written(pattern: str, seed: int) -> str:
    """The pattern with digits from a fixed recurrence."""
    out, state = [], seed * 7919 + 17
    for c in pattern:
        if c in "dh":
            state = (state * 1103515245 + 12345) % (1 << 31)
            out.append("0123456789abcdef"[(state >> 16) % (10 if c == "d" else 16)])
        else:
            out.append(c)
    return "".join(out)


def labelled_table(spark: SparkSession, copies: int = 3) -> DataFrame:
    """A small table of labelled sentences: every value in every frame, ``copies`` times."""
    rows = []
    single = [((kind, pattern),) for kind, patterns in [*VALUES.items(), ("", OTHER)] for pattern in patterns]
    for parts in [*single, *BESIDE]:
        for frame in FRAMES:
            for _ in range(copies):
                inside, marks = [], []
                for kind, pattern in parts:
                    value = _written(pattern, len(rows)).split()
                    inside += value
                    marks += [("B-" if i == 0 else "I-") + kind if kind else "O" for i in range(len(value))]
                before, after = frame.split("{}")
                left, right = before.split(), after.split()
                glued = "" if not right or after[0] == " " else right.pop(0)
                words = [*left, *inside[:-1], inside[-1] + glued, *right]
                rows.append((len(rows), words, ["O"] * len(left) + marks + ["O"] * len(right)))
    return spark.createDataFrame(rows, LABELLED_SCHEMA)


# Features.

WORD = re.compile(r"\S+")
_SHAPE = str.maketrans("0123456789" + "abcdefghijklmnopqrstuvwxyz" + "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "d" * 10 + "x" * 26 + "X" * 26)
_RUNS = re.compile(r"(.)\1+")
_EDGE = "\"'.,;:!?%$&*#<>{}|`~"


def trimmed(word: str) -> tuple[int, int]:
    """Where the word begins and ends without the punctuation around it."""
    start = len(word) - len(word.lstrip(_EDGE))
    return start, max(start, len(word.rstrip(_EDGE)))


def shape(word: str) -> str:
    return word.translate(_SHAPE)


def features(words: list[str | None], at: int) -> list[str]:
    """Of word ``at``; None stands for the border of the text."""

    def of(k: int) -> str | None:
        w = words[k] if 0 <= k < len(words) else None
        return None if w is None else w[slice(*trimmed(w))]

    own, prev, after = of(at) or "", of(at - 1), of(at + 1)
    form = shape(own)
    short = lambda w: "^" if w is None else _RUNS.sub(r"\1", shape(w))
    digits = sum(c.isdigit() for c in own)
    out = [
        "bias", "shape=" + form, "short=" + short(own), f"digits={min(digits, 20)}", f"groups={len(re.findall('[0-9]+', own))}",
        f"colons={min(own.count(':'), 3)}", f"letters={any(c.isalpha() for c in own)}", "at=" + str("@" in own),
        "prev=" + short(prev), "next=" + short(after), f"pair={short(prev)}|{short(own)}", f"pairnext={short(own)}|{short(after)}",
        "prevshape=" + ("^" if prev is None else shape(prev)), "nextshape=" + ("^" if after is None else shape(after)),
    ]
    if prev and prev.isalpha():
        out.append("word=" + prev.lower())
    return out


def is_item(word: str) -> bool:
    return "@" in word or any(c in "0123456789" for c in word)


@dataclass
class Finder:
    """A trained CRF with its feature index."""

    index: dict[str, int]
    model: Model

    def group(self, runs: list[list[list[str]]]) -> Group:
        """Runs of one length, each item a list of feature names."""
        feature, row = [], []
        for r, item in enumerate(i for run in runs for i in run):
            for name in item:
                if name in self.index:
                    feature.append(self.index[name])
                    row.append(r)
        return Group(len(runs), len(runs[0]), np.array(feature, np.int64), np.array(row, np.int64))


def runs_of(words: list[str]) -> list[list[int]]:
    runs: list[list[int]] = []
    for k, w in enumerate(words):
        if is_item(w):
            if runs and runs[-1][-1] == k - 1:
                runs[-1].append(k)
            else:
                runs.append([k])
    return runs


#: Most labelled sentences that are fitted; a labelled table is small by its nature.
MOST_SENTENCES = 20_000


def fit(labelled: DataFrame, most: int = MOST_SENTENCES) -> Finder:
    """Train on ``labelled`` (words, labels), at most its ``most`` first sentences by id.

    Rows with nulls are left out. Without rows nothing is ever added.
    """
    rows = labelled.dropna(subset=["words", "labels"]).orderBy("sentence_id").limit(most).select("words", "labels").collect()
    by_length: dict[int, list] = {}
    for words, labels in rows:
        for run in runs_of(list(words)):
            by_length.setdefault(len(run), []).append(([features(words, k) for k in run], [LABELS.index(labels[k]) for k in run]))
    index: dict[str, int] = {}
    for runs in by_length.values():
        for run, _ in runs:
            for item in run:
                for name in item:
                    index.setdefault(name, len(index))
    finder = Finder(index, Model(np.zeros((len(index) or 1, len(LABELS))), np.zeros((len(LABELS),) * 2), np.zeros(len(LABELS))))
    if by_length:
        groups = []
        for length in sorted(by_length):
            g = finder.group([run for run, _ in by_length[length]])
            g.label = np.array([labels for _, labels in by_length[length]])
            groups.append(g)
        finder.model = train(groups, len(index), len(LABELS), penalty=2e-4)
    return finder


#: Words of a run whose features are held at a time; longer runs (tables of numbers) are decoded by pieces, as one.
PIECE = 256


def added_spans(texts: list[str], finder: Finder, base: list[list[Span]]) -> list[list[Span]]:
    """Spans that the CRF finds outside the base spans, for a batch of texts."""
    waiting: dict[int, list[tuple[int, list[tuple[int, int]], list[list[str]]]]] = {}
    decoded: list[tuple[int, list[tuple[int, int]], np.ndarray]] = []
    scores = lambda items: emissions(finder.group(items), finder.model.weight)
    for t, text in enumerate(texts):
        for run in _item_runs(text):
            spots = [s[:2] for s in run if s[2]]
            words = [text[a:b] if a >= 0 else None for a, b, _ in run]
            shift = next(i for i, s in enumerate(run) if s[2])
            pieces = ([features(words, shift + i) for i in range(at, min(at + PIECE, len(spots)))] for at in range(0, len(spots), PIECE))
            if len(spots) <= PIECE:
                waiting.setdefault(len(spots), []).append((t, spots, next(pieces)))
            else:
                decoded.append((t, spots, viterbi_pieces((scores([items]) for items in pieces), finder.model)[0]))
    for runs in waiting.values():
        labels = viterbi(scores([r[2] for r in runs]), finder.model)
        decoded += [(t, spots, row) for (t, spots, _), row in zip(runs, labels, strict=True)]
    out: list[list[Span]] = [[] for _ in texts]
    taken = [_merged(spans) for spans in base]
    for t, spots, row in decoded:
        k = 0
        while k < len(row):
            name = LABELS[row[k]]
            if name[0] != "B":
                k += 1
                continue
            upto = k + 1
            while upto < len(row) and LABELS[row[upto]] == "I" + name[1:]:
                upto += 1
            head, tail = texts[t][slice(*spots[k])], texts[t][slice(*spots[upto - 1])]
            start, end = spots[k][0] + trimmed(head)[0], spots[upto - 1][0] + trimmed(tail)[1]
            if start < end and not _meets(taken[t], start, end):
                out[t].append((_OF[name[2:]], start, end))
            k = upto
    return out


def _merged(spans: list[Span]) -> tuple[list[int], list[int]]:
    """Starts and ends of the stretches that the spans cover, in order."""
    starts: list[int] = []
    ends: list[int] = []
    for _, a, b in sorted(spans, key=lambda s: s[1:]):
        if ends and a < ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)
    return starts, ends


def _meets(taken: tuple[list[int], list[int]], start: int, end: int) -> bool:
    at = bisect_right(taken[1], start)  # the first stretch that ends after the start
    return at < len(taken[0]) and taken[0][at] < end


ITEM = re.compile(r"[0-9@]\S*")


def _item_runs(text: str) -> Iterator[list[tuple[int, int, bool]]]:
    """Runs of neighbouring items as (start, end, is item), with the words around them."""
    run: list[tuple[int, int, bool]] = []
    for m in ITEM.finditer(text):
        start, end = m.span()
        while start and not text[start - 1].isspace():
            start -= 1
        if run and text[run[-1][1] : start].isspace():
            run.append((start, end, True))
            continue
        if run:
            yield _with_next(text, run)
        before = start
        while before and text[before - 1].isspace():
            before -= 1
        left = before
        while left and not text[left - 1].isspace():
            left -= 1
        run = [(left, before, False) if left < before else (-1, -1, False), (start, end, True)]
    if run:
        yield _with_next(text, run)


def _with_next(text: str, run: list[tuple[int, int, bool]]) -> list[tuple[int, int, bool]]:
    m = WORD.search(text, run[-1][1])
    return [*run, (*m.span(), False) if m else (-1, -1, False)]


SPANS = "array<struct<kind:int,start:int,end:int>>"
_ARROW = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))


def _found(texts: list[str], finder: Finder) -> tuple[list[list[Span]], list[list[Span]]]:
    base = [base_spans(t) for t in texts]
    return base, added_spans(texts, finder, base)


def find(docs: DataFrame, finder: Finder) -> DataFrame:
    """``doc_id``, ``base`` and ``added`` spans of every row, as ``SPANS``."""
    kept = docs.select("doc_id").schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in (whole.slice(i, 1024) for i in range(0, whole.num_rows, 1024)):
                base, added = _found([t or "" for t in batch.column(1).to_pylist()], finder)
                lists = [pa.array([[dict(zip(("kind", "start", "end"), s, strict=True)) for s in x] for x in y], _ARROW) for y in (base, added)]
                yield pa.RecordBatch.from_arrays([batch.column(0), *lists], names=["doc_id", "base", "added"])

    return docs.select("doc_id", "text").mapInArrow(frugal(run), f"doc_id {kept}, base {SPANS}, added {SPANS}")


def written(spans: Column) -> Column:
    """Spans as kind:start:end, by kind, then start, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.concat_ws(",", F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", names[s["kind"]], s["start"], s["end"])))


def redact(docs: DataFrame, finder: Finder) -> DataFrame:
    """``docs`` with every span of ``text`` replaced by its kind in angle brackets.

    A span inside or across another is merged with it and takes the first kind.
    Null texts stay null; all columns are kept, in their order.
    """
    names = docs.columns
    at = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in (whole.slice(i, 1024) for i in range(0, whole.num_rows, 1024)):
                texts = batch.column(at).to_pylist()
                plain = [t or "" for t in texts]
                base, added = _found(plain, finder)
                new = [None if t is None else _masked(t, b + a) for t, b, a in zip(texts, base, added, strict=True)]
                columns = [pa.array(new, pa.string()) if i == at else batch.column(i) for i in range(batch.num_columns)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.mapInArrow(frugal(run), docs.schema)


def _masked(text: str, spans: list[Span]) -> str:
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= at:
            out += [text[at:start], f"<{KINDS[kind].upper()}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])
