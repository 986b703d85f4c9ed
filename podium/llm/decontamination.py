"""Benchmark decontamination: BM25 retrieval of test items, then a check of question and answer.

The check is met by shingles of both, found anywhere in the document, or, in a retrieved passage, by a copy
that edits have changed: the words of a part are aligned with the passage, and what counts is the share of
them that needs no replacing, inserting or leaving out.

The test items are the indexed side and every passage of the corpus is a query. A posting holds an
item's share: the term's BM25 weight over the item's score against itself, so one threshold means the
same part of any item. Postings are sorted by item and cut into blocks with their largest share, and
queries run block-max WAND: cursors over the passage's terms, a pivot where the terms' bounds can reach
the threshold, a second test with the blocks' bounds, then scoring or a jump past the blocks.

Almost no passage holds a test item, so WAND's first question, can anything here reach the threshold at
all, is asked for a whole document at a time: an item's heavy terms are those left when its lightest,
up to ``LIGHT`` of its share, are set aside, and a passage whose heavy terms plus that light part stay
below the threshold cannot reach it. The test is a bound, it loses nothing.

The index is split into parts of a bounded number of words, each sent to the executors on its own; the
corpus is read in blocks against every part and never shuffled.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from podium.llm.common import slices, stored

THRESHOLD = 0.6  # of an item's own score
LIGHT = 0.3
OVERLAP = 0.8
NEARLY = 0.85  # of a whole item's words, or of the question's before an answer of one shingle
SHINGLE = 5
K1, B = 1.2, 0.75
BLOCK = 16
PASSAGE = 128
PART_WORDS = 200_000
_WORD = re.compile(r"\w+")
_SENTENCE = re.compile(r"(?<=[.!?])\s+")


def words_in(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def question_and_answer(text: str) -> tuple[list[str], list[str]]:
    """Words of an item's question and of its answer, the last sentence; one sentence is both."""
    sentences = [s for s in _SENTENCE.split(text.strip()) if _WORD.search(s)]
    if len(sentences) < 2:
        return words_in(text), words_in(text)
    return words_in(" ".join(sentences[:-1])), words_in(sentences[-1])


def shingles(words: list[str], k: int = SHINGLE) -> set[tuple[str, ...]]:
    k = min(k, len(words))
    return {tuple(words[i:i + k]) for i in range(len(words) - k + 1)} if k else set()


def kept_words(wanted: list[str], passage: list[str]) -> float:
    """Share of ``wanted`` left after the fewest word edits to any stretch of ``passage``, by bit vectors."""
    n = len(wanted)
    places: dict[str, int] = {}
    for i, word in enumerate(wanted):
        places[word] = places.get(word, 0) | 1 << i
    every, last = (1 << n) - 1, 1 << n - 1
    more, less, edits, fewest = every, 0, n, n
    for word in passage:
        equal = places.get(word, 0)
        vertical = equal | less
        across = ((((equal & more) + more) ^ more) | equal) & every
        up, down = less | (every & ~(across | more)), more & across
        edits += 1 if up & last else -1 if down & last else 0
        fewest = min(fewest, edits)
        up, down = up << 1 & every, down << 1 & every
        more, less = down | (every & ~(vertical | up)), up & vertical
    return (n - fewest) / n


@dataclass
class Postings:
    """A term's items in order, their shares, and per block the last item and the largest share."""

    items: np.ndarray
    shares: np.ndarray
    bound: float = 0.0
    lasts: list[int] = field(default_factory=list)
    maxima: list[float] = field(default_factory=list)

    def __post_init__(self):
        starts = range(0, len(self.items), BLOCK)
        self.lasts = [int(self.items[min(s + BLOCK, len(self.items)) - 1]) for s in starts]
        self.maxima = [float(self.shares[s:s + BLOCK].max()) for s in starts]
        self.bound = max(self.maxima)
        self.items, self.shares = self.items.tolist(), self.shares.tolist()


class Cursor:
    __slots__ = ("list", "at", "block", "item")

    def __init__(self, postings: Postings):
        self.list, self.at, self.block, self.item = postings, 0, 0, postings.items[0]

    def shallow(self, item: int) -> None:
        """Move the block, not the cursor, to where ``item`` would be."""
        lasts = self.list.lasts
        while self.block < len(lasts) and lasts[self.block] < item:
            self.block += 1

    def seek(self, item: int) -> None:
        self.shallow(item)
        items = self.list.items
        self.at = max(self.at, self.block * BLOCK)
        while self.at < len(items) and items[self.at] < item:
            self.at += 1
        self.item = items[self.at] if self.at < len(items) else _DONE


_DONE = 1 << 60


def block_max_wand(lists: list[Postings], threshold: float) -> list[tuple[int, float]]:
    """Items whose shares over the given terms add up to the threshold or more, in order."""
    threshold -= 1e-9
    cursors, found = [Cursor(p) for p in lists], []
    while True:
        cursors = sorted((c for c in cursors if c.item < _DONE), key=lambda c: c.item)
        bound, pivot = 0.0, -1
        for k, c in enumerate(cursors):
            bound += c.list.bound
            if bound >= threshold:
                pivot = k
                break
        if pivot < 0:
            return found
        item = cursors[pivot].item
        while pivot + 1 < len(cursors) and cursors[pivot + 1].item == item:
            pivot += 1
        ahead = cursors[:pivot + 1]
        best = 0.0
        for c in ahead:
            c.shallow(item)
            if c.block < len(c.list.lasts):
                best += c.list.maxima[c.block]
        if best < threshold:
            # Nothing up to the nearest block end, or the next cursor, can reach it.
            ends = [c.list.lasts[c.block] + 1 for c in ahead if c.block < len(c.list.lasts)]
            jump = min([*ends, *(c.item for c in cursors[pivot + 1:pivot + 2])], default=_DONE)
            for c in ahead:
                c.seek(max(jump, item + 1))
        elif ahead[0].item == item:
            score = sum(c.list.shares[c.at] for c in ahead)
            if score >= threshold:
                found.append((item, score))
            for c in ahead:
                c.seek(item + 1)
        else:
            for c in ahead:
                if c.item < item:
                    c.seek(item)


class Index:
    """A part of the test items, ready to be queried."""

    def __init__(self, items: list[tuple[int, str]], frequency: dict[str, int], n_items: int, mean_words: float,
                 passage: int = PASSAGE):
        counts = [Counter(words_in(text)) for _, text in items]
        self.ids = [i for i, _ in items]
        self.words = [question_and_answer(text) for _, text in items]
        self.wholes = [words_in(text) for _, text in items]
        self.parts = [tuple(map(shingles, both)) for both in self.words]
        lengths = [sum(c.values()) for c in counts]
        postings: dict[str, list[tuple[int, float]]] = defaultdict(list)
        heavy: dict[str, list[tuple[int, float]]] = defaultdict(list)
        self.light = np.zeros(len(items))
        for k, terms in enumerate(counts):
            norm = K1 * (1 - B + B * lengths[k] / mean_words)
            weights = {t: np.log1p((n_items - frequency[t] + 0.5) / (frequency[t] + 0.5)) * n * (K1 + 1) / (n + norm)
                       for t, n in terms.items()}
            whole = sum(weights.values())
            for t, w in sorted(weights.items(), key=lambda x: (x[1], x[0])):
                share = float(w / whole)
                postings[t].append((k, share))
                if self.light[k] + share <= LIGHT:
                    self.light[k] += share
                else:
                    heavy[t].append((k, share))
        self.vocabulary = {t: n for n, t in enumerate(postings)}
        self.lists = [Postings(np.array([k for k, _ in p]), np.array([s for _, s in p])) for p in postings.values()]
        rows = [heavy.get(t, []) for t in postings]
        self.heavy_starts = np.cumsum([0, *map(len, rows)])
        self.heavy_items = np.array([k for row in rows for k, _ in row], np.int64)
        self.heavy_shares = np.array([s for row in rows for _, s in row])
        self.stride = max(passage // 2, max(lengths, default=1))

    def terms_of(self, words: list[str]) -> np.ndarray:
        get, unknown = self.vocabulary.get, -1
        return np.fromiter((get(w, unknown) for w in words), np.int64, len(words))

    def retrieved(self, terms: np.ndarray, threshold: float) -> dict[int, tuple[float, list[int]]]:
        """Items that some passage retrieves, with their best share and these passages.

        Passages are two strides long and start at every stride, so no item of a stride's length is cut.
        """
        best: dict[int, tuple[float, list[int]]] = {}
        for passage in self._hopeful(terms, threshold):
            held = np.unique(terms[passage * self.stride:(passage + 2) * self.stride])
            for item, score in block_max_wand([self.lists[t] for t in held.tolist() if t >= 0], threshold):
                before, places = best.get(item, (0.0, []))
                best[item] = max(score, before), [*places, passage]
        return best

    def _hopeful(self, terms: np.ndarray, threshold: float) -> list[int]:
        """Passages whose heavy terms leave some item within reach of the threshold."""
        at = np.flatnonzero(terms >= 0)
        found = terms[at]
        wide = self.heavy_starts[found + 1] - self.heavy_starts[found]
        at, found, wide = at[wide > 0], found[wide > 0], wide[wide > 0]
        if not len(at):
            return []
        place = at // self.stride
        both = np.unique(np.concatenate([place, np.maximum(place - 1, 0)]) * len(self.lists) + np.concatenate([found, found]))
        passage, term = both // len(self.lists), both % len(self.lists)
        wide = self.heavy_starts[term + 1] - self.heavy_starts[term]
        entry = np.repeat(self.heavy_starts[term] - np.concatenate([[0], np.cumsum(wide)[:-1]]), wide) + np.arange(wide.sum())
        key = np.repeat(passage, wide) * len(self.ids) + self.heavy_items[entry]
        keys, inverse = np.unique(key, return_inverse=True)
        reach = np.bincount(inverse, weights=self.heavy_shares[entry]) + self.light[keys % len(self.ids)]
        return np.unique(keys[reach >= threshold - 1e-6] // len(self.ids)).tolist()

    def leaks(self, text: str | None, threshold: float = THRESHOLD, overlap: float = OVERLAP) -> list[tuple[int, float, float, float]]:
        """Item, share, and the parts of its question and answer found in the text, enough of them."""
        words = words_in(text) if text else []
        found = self.retrieved(self.terms_of(words), threshold) if words else {}
        out = []
        held: dict[int, set] = {}
        for k, (share, passages) in sorted(found.items()):
            parts = []
            for wanted in self.parts[k]:
                width = len(next(iter(wanted)))
                if width not in held:
                    held[width] = shingles(words, width)
                parts.append(len(wanted & held[width]) / len(wanted))
            if min(parts) >= overlap:
                out.append((self.ids[k], share, *parts))
            elif near := self._nearly(k, words, passages, parts, overlap):
                out.append((self.ids[k], share, *near))
        return out

    def _nearly(self, item: int, words: list[str], passages: list[int], parts: list[float], overlap: float) -> list[float]:
        """The parts of question and answer that a retrieved passage keeps, if it holds an edited copy.

        That is enough of both, nearly the whole item, or nearly all of the question where the answer is no
        longer than a shingle. Passages are read half a stride further, as edits may have added words.
        """
        whole, answer = self.wholes[item], self.words[item][1]
        for at in passages:
            passage = words[at * self.stride:(at + 2) * self.stride + self.stride // 2]
            kept = [max(part, kept_words(wanted, passage)) for part, wanted in zip(parts, self.words[item])]
            if (min(kept) >= overlap or len(answer) <= SHINGLE and kept[0] >= NEARLY
                    or kept_words(whole, passage) >= NEARLY):
                return kept
        return []


def index_parts(items: DataFrame, part_words: int = PART_WORDS) -> Iterator[Index]:
    """The index, part by part; a part holds up to ``part_words`` words, or one longer item.

    Items without words are left out. Weights count over all items. The driver holds one part at a time.
    """
    split = F.udf(lambda text: len(words_in(text)) if text else 0, "int")
    rows = items.select("item_id", "text").withColumn("words", split("text")).filter("words > 0")
    before = Window.orderBy("item_id", "text").rowsBetween(Window.unboundedPreceding, -1)
    narrow = rows.withColumn("part", F.floor(F.coalesce(F.sum("words").over(before), F.lit(0)) / part_words).cast("int"))
    rows = stored(narrow, "items")
    total = rows.agg(F.count("*").alias("n"), F.avg("words").alias("mean"), F.max("part").alias("last")).first()
    if not total["n"]:
        return
    terms = F.udf(lambda text: sorted(set(words_in(text))), "array<string>")
    held = rows.select("part", F.explode(terms("text")).alias("term"))
    frequency = stored(held.groupBy("term").agg(F.count("*").alias("n")), "frequency")
    for part in range(total["last"] + 1):
        own = rows.filter(F.col("part") == part).orderBy("item_id", "text").select("item_id", "text").collect()
        if own:
            counts = frequency.join(held.filter(F.col("part") == part).select("term").distinct(), "term").collect()
            yield Index([(r[0], r[1]) for r in own], {r["term"]: r["n"] for r in counts}, total["n"], total["mean"])


def contaminated(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, overlap: float = OVERLAP) -> DataFrame:
    """``doc_id``, ``item_id``, ``share``, ``question_overlap``, ``answer_overlap`` per leak.

    An item leaks into a document if a passage reaches ``threshold`` of its score and ``overlap`` of the
    five-word shingles of its question and of its answer occur in the document, or the passage holds an edited
    copy: word for word, ``overlap`` of question and answer, ``NEARLY`` of the whole, or ``NEARLY`` of the question
    if the answer has at most five words. A question without its longer answer is no leak. Null and empty texts and
    items give no rows; repeated rows repeat theirs; equal items are reported each; an empty side gives
    no rows; extra columns are not read.
    """
    schema = "doc_id bigint, item_id bigint, share double, question_overlap double, answer_overlap double"
    parts = [_against(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), docs.sparkSession.sparkContext.broadcast(index),
                      threshold, overlap, schema) for index in index_parts(items)]
    if not parts:
        return docs.sparkSession.createDataFrame([], schema)
    return _union(parts)


def _union(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def _against(docs: DataFrame, index, threshold: float, overlap: float, schema: str) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "item_id", "share", "question_overlap", "answer_overlap"]
        kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64()]
        for batch in slices(batches):
            rows = [(doc_id, *leak) for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                    for leak in index.value.leaks(text, threshold, overlap)]
            columns = zip(*rows) if rows else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names)

    return docs.mapInArrow(work, schema)


def uncontaminated(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, overlap: float = OVERLAP,
                   part_words: int = PART_WORDS) -> DataFrame:
    """The rows of ``docs``, all their columns, into which no item leaks.

    Rows pass one filter per part of the index, whole and in place: no id is needed and nothing is joined. What passed
    a part is stored before the next, so a worker holds one part at a time and leaking rows are read no further; up
    to ``PART_WORDS`` words of items there is one part and nothing is stored. Null and empty texts and rows without
    id stay, repeated rows stay or go together; no items leave all rows, an empty table none.
    """
    for number, part in enumerate(index_parts(items, part_words)):
        if number:
            docs = stored(docs, "clean-so-far")
        index = docs.sparkSession.sparkContext.broadcast(part)
        clean = F.arrow_udf(_clean(index, threshold, overlap), "boolean")
        docs = docs.filter(clean(F.col("text")))
    return docs


def _clean(index, threshold: float, overlap: float):
    def clean(texts):
        return pa.array([not index.value.leaks(text.as_py(), threshold, overlap) for text in texts], pa.bool_())
    return clean
