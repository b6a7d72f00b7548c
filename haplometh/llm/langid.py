"""Language of each word of a text by a linear-chain CRF, and of the text as a whole.

A word's features are its letter n-grams with the word's borders (so prefixes
and suffixes too) and its entry in a lexicon of frequent words; transitions are
learned from sequences that switch language. Forward-backward gives every word
a probability per language; their mean decides for the text.

A word is a run of letters, lower-cased. Null texts and texts without a letter
are ``und`` with score 0, as is every text when there is nothing to learn from.
Texts are read whole; repeated rows are each labelled; ties go to the language
that sorts first; other columns are ignored. A null doc_id is never learned from.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from haplometh.llm.arrow import steps
from haplometh.llm.crf import Group, train
from haplometh.llm.words import mixed

UNKNOWN = "und"
#: Bits of an n-gram's place in the table of weights.
GRAM_BITS = 15
#: Bounds of the sample that is fitted, for each language.
SAMPLE_DOCS, SAMPLE_CHARS, LEXICON = 250, 3000, 4000
#: Words of a training sequence, and sequences in all.
SEQUENCE, SEQUENCES = 24, 3000

_LETTER: list[np.ndarray] = []


def _letters() -> np.ndarray:
    if not _LETTER:
        _LETTER.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _LETTER[0]


@dataclass
class Grams:
    """Letter n-grams of consecutive words: those of word ``w`` are at ``first[w]:first[w + 1]``."""

    index: np.ndarray  # [n-grams, 3]
    first: np.ndarray
    hash: np.ndarray  # of words
    text_first: np.ndarray  # words of text i: text_first[i]:text_first[i + 1]
    span: np.ndarray  # [words, 2], in code points of the lower-cased text


def grams(texts: list[str]) -> Grams:
    lowered = [t.lower() for t in texts]
    joined = "\n\n\n" + "\n".join(lowered) + "\n"
    code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[code]
    c = np.where(letter, code, 0).astype(np.uint64)
    before = np.zeros(len(c), bool)
    before[1:] = letter[:-1]
    at = np.flatnonzero(letter | before)  # every letter, and the border behind each word
    one = c[at - 1]
    two = np.where(one > 0, c[at - 2], 0)
    three = np.where(two > 0, c[at - 3], 0)
    pair = c[at] * np.uint64(0x9E3779B1) + one * np.uint64(0x85EBCA77C2B2AE63)
    triple = pair + two * np.uint64(0xC2B2AE3D27D4EB4F)
    index = np.empty((len(at), 3), np.int32)
    shift = np.uint64(64 - GRAM_BITS)
    for k, x in enumerate((pair, triple, triple + three * np.uint64(0x165667B19E3779F9))):
        index[:, k] = ((x + np.uint64(k)) * np.uint64(0xD6E8FEB86659FD93) ^ x >> np.uint64(29)) * np.uint64(0x94D049BB133111EB) >> shift
    opens = letter[at] & ~before[at]
    start = np.flatnonzero(opens)
    first = np.append(start, len(at))
    size = np.minimum(np.arange(len(at)) - np.repeat(start, np.diff(first)), 63) if len(start) else np.empty(0, int)
    place = np.cumprod(np.full(64, 0xA0761D6478BD642F, np.uint64))
    hashed = mixed(np.add.reduceat(c[at] * place[size], start)) if len(start) else np.empty(0, np.uint64)
    lengths = np.fromiter(map(len, lowered), np.int64, len(lowered)) + 1
    text_start = 3 + np.concatenate(([0], np.cumsum(lengths)))
    begin, end = at[start], at[first[1:] - 1]
    text_first = np.searchsorted(begin, text_start)
    shift = np.repeat(text_start[:-1], np.diff(text_first))
    return Grams(index, first, hashed, text_first, np.stack((begin - shift, end - shift), axis=1))


@dataclass
class LanguageModel:
    languages: list[str]
    gram: np.ndarray = field(default_factory=lambda: np.zeros((1 << GRAM_BITS, 0), np.float32))
    lexicon: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))  # sorted hashes
    word: np.ndarray = field(default_factory=lambda: np.zeros((1, 0), np.float32))  # the last row: no entry
    transition: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))
    start: np.ndarray = field(default_factory=lambda: np.zeros(0))


def lexicon_rows(lexicon: np.ndarray, hashed: np.ndarray) -> np.ndarray:
    """Each word's row of the lexicon; its length where there is none."""
    if not len(lexicon):
        return np.zeros(len(hashed), np.int64)
    at = np.minimum(np.searchsorted(lexicon, hashed), len(lexicon) - 1)
    return np.where(lexicon[at] == hashed, at, len(lexicon))


def learn(sample: list[tuple[str, str]]) -> LanguageModel:
    """A model from (language, text) pairs.

    Training sequences join stretches of one to three texts, so that switches
    of language occur; which stretches is a fixed function of their number.
    """
    languages = sorted({lang for lang, _ in sample})
    if not languages:
        return LanguageModel([])
    sample = sorted(sample)
    g = grams([text for _, text in sample])
    owner = np.repeat([languages.index(lang) for lang, _ in sample], np.diff(g.text_first))
    frequent = []
    for k in range(len(languages)):
        values, counts = np.unique(g.hash[owner == k], return_counts=True)
        frequent.append(values[np.lexsort((values, -counts))][:LEXICON][: int((counts > 1).sum())])
    lexicon = np.unique(np.concatenate(frequent))
    rows = lexicon_rows(lexicon, g.hash)
    n = len(g.hash)
    if not n:
        return LanguageModel([])
    draw = mixed(np.arange(SEQUENCES * 6, dtype=np.uint64)).reshape(SEQUENCES, 6)
    by_language = [np.flatnonzero(owner == k) for k in range(len(languages)) if (owner == k).any()]
    chosen = np.empty((SEQUENCES, SEQUENCE), np.int64)
    for s in range(SEQUENCES):
        cut = sorted(int(x % np.uint64(SEQUENCE + 1)) for x in draw[s, :2]) if s % 2 else [SEQUENCE, SEQUENCE]
        for part, (a, b) in enumerate(zip([0, *cut], [*cut, SEQUENCE], strict=True)):
            words = by_language[(s + part * (1 + s // 2)) % len(by_language)]
            at = int(draw[s, 2 + part] % np.uint64(max(1, len(words) - SEQUENCE)))
            chosen[s, a:b] = words[(at + np.arange(b - a)) % len(words)]
    flat = chosen.ravel()
    sizes = g.first[flat + 1] - g.first[flat]
    spread = np.repeat(g.first[flat] - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes) + np.arange(sizes.sum())
    row = np.repeat(np.arange(len(flat)), sizes)
    entry = rows[flat]
    listed = np.flatnonzero(entry < len(lexicon))
    feature = np.concatenate((g.index[spread].ravel(), (1 << GRAM_BITS) + entry[listed]))
    group = Group(SEQUENCES, SEQUENCE, feature, np.concatenate((np.repeat(row, 3), listed)), owner[chosen])
    model = train([group], (1 << GRAM_BITS) + len(lexicon), len(languages), penalty=1e-5, rounds=40, rate=0.1)
    weight = model.weight.astype(np.float32)
    none = np.zeros((1, len(languages)), np.float32)
    return LanguageModel(languages, weight[: 1 << GRAM_BITS], lexicon, np.concatenate((weight[1 << GRAM_BITS :], none)), model.transition, model.start)


#: Consecutive words that are combined in parallel with the other blocks.
BLOCK = 128


def word_probabilities(emission: np.ndarray, opens: np.ndarray, model: LanguageModel) -> np.ndarray:
    """Forward-backward over all texts of a step at once.

    The texts stand in one chain; at a text's first word the transition forgets
    what came before. The chain is cut into blocks: their transfer matrices are
    multiplied in parallel, chained, and then filled in, again in parallel.
    """
    n, labels = emission.shape
    blocks = -(-n // BLOCK)
    e = np.ones((blocks * BLOCK, labels))
    e[:n] = np.exp(emission - emission.max(axis=1, keepdims=True))
    e = e.reshape(blocks, BLOCK, labels)
    reset = np.zeros(blocks * BLOCK, bool)
    reset[:n], reset[n:] = opens, True
    reset = reset.reshape(blocks, BLOCK)
    move = np.exp(model.transition - model.transition.max())
    begin = np.tile(np.exp(model.start - model.start.max()), (labels, 1))

    def matrix(k: int) -> np.ndarray:
        return np.where(reset[:, k, None, None], begin, move) * e[:, k, None, :]

    product = matrix(0)
    for k in range(1, BLOCK):
        product = product @ matrix(k)
        product /= product.max(axis=(1, 2), keepdims=True)
    into, out = np.full((blocks, labels), 1.0 / labels), np.ones((blocks, labels))
    for b in range(1, blocks):
        x = into[b - 1] @ product[b - 1]
        into[b] = x / x.sum()
    for b in range(blocks - 1, 0, -1):
        x = product[b] @ out[b]
        out[b - 1] = x / x.sum()
    probability = np.empty_like(e)
    state = into[:, None, :]
    for k in range(BLOCK):
        state = state @ matrix(k)
        state /= state.sum(axis=2, keepdims=True)
        probability[:, k] = state[:, 0]
    state = out[:, :, None]
    for k in range(BLOCK - 1, -1, -1):
        probability[:, k] *= state[:, :, 0]
        state = matrix(k) @ state
        state /= state.sum(axis=1, keepdims=True)
    probability = probability.reshape(-1, labels)[:n]
    return probability / probability.sum(axis=1, keepdims=True)


def label_words(texts: list[str], model: LanguageModel) -> tuple[np.ndarray, np.ndarray]:
    """Probabilities [words, languages] of all texts' words, and each text's first word."""
    probability, first, _ = labelled_words(texts, model)
    return probability, first


def labelled_words(texts: list[str], model: LanguageModel) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``label_words``, and each word's start and end in its text."""
    g = grams(texts)
    if not len(g.hash) or not model.languages:
        return np.empty((0, len(model.languages))), np.zeros(len(texts) + 1, np.int64), np.empty((0, 2), np.int64)
    for t, text in enumerate(texts):
        if len(text.lower()) != len(text):  # a letter that is two in lower case
            own = slice(g.text_first[t], g.text_first[t + 1])
            origin = np.repeat(np.arange(len(text)), [len(c.lower()) for c in text])
            g.span[own] = np.stack((origin[g.span[own, 0]], origin[g.span[own, 1] - 1] + 1), axis=1)
    score = model.gram[g.index[:, 0]]
    score += model.gram[g.index[:, 1]]
    score += model.gram[g.index[:, 2]]
    emission = np.add.reduceat(score, g.first[:-1], axis=0).astype(np.float64)
    emission += model.word[lexicon_rows(model.lexicon, g.hash)]
    opens = np.zeros(len(g.hash), bool)
    opens[g.text_first[:-1][np.diff(g.text_first) > 0]] = True
    return word_probabilities(emission, opens, model), g.text_first, g.span


def decided(probability: np.ndarray, first: np.ndarray, model: LanguageModel) -> tuple[list[str], list[float]]:
    """Language and score of each text from those of its words."""
    n = len(first) - 1
    langs, scores = [UNKNOWN] * n, [0.0] * n
    full = np.flatnonzero(np.diff(first))
    if len(full):
        mean = np.add.reduceat(probability, first[full], axis=0) / np.diff(first)[full, None]
        best = mean.argmax(axis=1)
        for i, t in enumerate(full):
            langs[t], scores[t] = model.languages[best[i]], float(min(1.0, mean[i, best[i]]))
    return langs, scores


def remainder(doc_id: str = "doc_id") -> Column:
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(3))


def fit(docs: DataFrame, docs_each: int = SAMPLE_DOCS, chars_each: int = SAMPLE_CHARS) -> LanguageModel:
    """Learn from at most ``docs_each`` documents of each language and ``chars_each`` letters of each.

    Only rows whose id's checksum leaves a remainder other than 1 are read.
    Which ones is a function of ids and texts: the smallest hashes. Rows that
    repeat both count once.
    """
    open_rows = docs.filter((remainder() != 1) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    open_rows = open_rows.withColumn("digest", F.xxhash64("text"))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id", "digest")
    ranked = open_rows.select("lang", "doc_id", "digest").distinct().withColumn("n", F.row_number().over(order)).filter(F.col("n") <= docs_each)
    chosen = {tuple(r) for r in ranked.select("lang", "doc_id", "digest").collect()}
    if not chosen:
        return LanguageModel([])
    ids = sorted({doc_id for _, doc_id, _ in chosen if doc_id is not None})
    digests = sorted({digest for *_, digest in chosen})
    middle = F.greatest(F.lit(1), ((F.length("text") - chars_each) / 2).cast("int"))
    rows = open_rows.filter((F.col("doc_id").isNull() | F.col("doc_id").isin(ids)) & F.col("digest").isin(digests))
    rows = rows.select("lang", "doc_id", "digest", F.substring("text", middle, F.lit(chars_each)).alias("part")).dropDuplicates(["lang", "doc_id", "digest"])
    read = [r for r in rows.collect() if tuple(r)[:3] in chosen]
    return learn([(r["lang"], r["part"]) for r in sorted(read, key=lambda r: (r["lang"], r["digest"], r["doc_id"] is None, r["doc_id"] or 0))])


WORDS = "array<struct<start:int,end:int,lang:string,probability:double>>"


def labelled(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score`` and ``words`` of every row; only ``text`` decides.

    ``words`` (as ``WORDS``) has each word's span in code points, end exclusive,
    its likeliest language and that one's probability; none without a model.
    """
    kept = docs.select("doc_id").schema[0].dataType.simpleString()
    told = docs.sparkSession.sparkContext.broadcast(model)  # fixed tables and a bounded lexicon

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = pa.array(told.value.languages, pa.string())
        for whole in batches:
            for batch in steps(whole):
                probability, first, span = labelled_words([t or "" for t in batch.column("text").to_pylist()], told.value)
                langs, scores = decided(probability, first, told.value)
                best = probability.argmax(axis=1) if len(probability) else np.empty(0, np.int64)
                columns = [pa.array(span[:, 0], pa.int32()), pa.array(span[:, 1], pa.int32()), names.take(pa.array(best)), pa.array(probability[np.arange(len(best)), best], pa.float64())]
                words = pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.StructArray.from_arrays(columns, names=["start", "end", "lang", "probability"]))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(langs, pa.string()), pa.array(scores, pa.float64()), words], names=["doc_id", "lang_pred", "score", "words"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kept}, lang_pred string, score double, words {WORDS}")


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``doc_id``, ``lang_pred`` and ``score`` of every row, from the pass that labels its words."""
    return labelled(docs, model).select("doc_id", "lang_pred", "score")
