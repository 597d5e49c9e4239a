"""Language-model scoring with a weighted backoff automaton.

The model is a smoothed n-gram model of the training documents (hierarchical Dirichlet smoothing):
``p(w | h) = (c(hw) + STRENGTH * p(w | h')) / (c(h) + STRENGTH)`` where ``h'`` is ``h`` without its
first word, down to ``p(w) = (c + 0.5) / (N + 0.5 * (V + 1))``. As an automaton: states are the
histories seen in training; an arc for each seen n-gram carries its log probability and leads to the
longest history that is a state; a state without an arc for the next word has a failure arc to its
shorter history, with weight ``STRENGTH / (c(h) + STRENGTH)``; the empty state reads every word. One
left-to-right traversal of a document carries the state and adds up the weights. A state depends on
the last ``order - 1`` words only, so a long text is read in pieces side by side, each of which finds
its state on those words.

The model is as large as the corpus and is never in one place. Documents are dealt into blocks; a block
asks for the counts of the n-grams that its own texts contain (those of its training documents are what
the corpus counts are made of), gets them in the order it asked, and builds the part of the automaton
that its documents can reach. See ``exchange``. N-grams and words are known by 64-bit hashes.

Words and pairs are asked about first, then each longer n-gram in a round of its own, and only where both
of the n-grams that are one word shorter are counted in training and stand in several blocks. Of all
others a block knows the count: it is 0, or no other block holds the n-gram.

Nulls: a null text counts as empty (its only token is the end); a null ``train`` flag means no. A row
with a null id is scored too. Repeated rows are learned and scored one by one. Without training
documents every count is 0. An empty table gives an empty result. Only the id, the text and the flag
are read, so further columns may have any name.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrier.llm import exchange, text

ORDER = 3
STRENGTH = 800.0  # best on held-out documents of the test tables among 2 to 3,000
PIECE = 512  # tokens read in step
_START, _END = np.uint64(0x5354415254), np.uint64(0x454E44)
_TAG = np.uint64(7)  # low bits of a key: the order of its n-gram, 0 for the start of a document
_EMPTY = -1
_LONE = 1

ANSWERED = exchange.ANSWERED + ", round int, tokens long, words long"


class Grams:
    """The n-grams of some documents. Rows of ``keys`` belong to orders, columns to tokens.

    Each document is its start, its words and its end; the start is never a token to predict.
    """

    def __init__(self, texts, order: int):
        sequences, sizes = [], []
        for _, data, offsets in text.parts(texts):
            words = text.Words(data, offsets)
            n = words.counts() + 2
            first = np.cumsum(n) - n
            sequence = np.empty(n.sum(), np.uint64)
            sequence[first] = _START
            sequence[first + n - 1] = _END
            sequence[np.arange(len(words.doc)) + 2 * words.doc + 1] = words.hashes()
            sequences.append(sequence)
            sizes.append(n)
        self.sizes = np.concatenate(sizes) if sizes else np.zeros(0, np.int64)
        sequence = np.concatenate(sequences) if sequences else np.zeros(0, np.uint64)
        self.first = np.cumsum(self.sizes) - self.sizes
        self.doc = np.repeat(np.arange(len(self.sizes)), self.sizes)
        self.place = np.arange(len(sequence)) - self.first[self.doc]
        odd = text.seeds(order, 77) | np.uint64(1)
        rows, total = [], np.zeros(len(sequence), np.uint64)
        for k in range(order):
            total = total + np.r_[np.zeros(min(k, len(sequence)), np.uint64), sequence[: max(0, len(sequence) - k)]] * odd[k]
            tag = np.where(self.place == 0, 0, k + 1) if k == 0 else k + 1
            rows.append((text.mixed(total + np.uint64(k)) & ~_TAG) | np.asarray(tag, np.uint64))
        self.keys = np.stack(rows)
        self.exists = np.stack([self.place >= k for k in range(order)])

    def indexed(self) -> tuple[np.ndarray, np.ndarray]:
        """Sorted distinct keys, and for every order and token the place of its key (or -1)."""
        distinct, rank, _ = text.ranked(self.keys[self.exists])
        index = np.full(self.keys.shape, -1, np.int64)
        index[self.exists] = rank
        return distinct, index


class Automaton:
    """The part of the model that the documents of ``grams`` can reach.

    ``count`` has the corpus count of every distinct n-gram, of which ``index`` has the places. States
    and arcs are named by n-grams: a state is its history, an arc the n-gram of its source and word.
    So the arc of a state of ``d`` words for the next word of a text is the n-gram of ``d + 1`` words
    that ends there, if the model has it.
    """

    def __init__(self, grams: Grams, index: np.ndarray, count: np.ndarray, tokens: int, words: int,
                 strength: float):
        order = len(index)
        self.order, self.index = order, index
        read = grams.place > 0  # the start is a history, never read
        chance = np.where(read, (count[index[0]] + 0.5) / (tokens + 0.5 * (words + 1)), 1.0)
        self.base = np.log10(chance)
        # Unseen words lead to the empty state, as all words do if no history counts.
        self.next = np.where((count > 0) & (order > 1), np.arange(len(count)), _EMPTY)
        self.shorter = np.full(len(count) + 1, _EMPTY)  # where failure arcs lead; last: the empty state
        self.depth = np.zeros(len(count) + 1, np.int64)
        self.weight = np.full(len(count), np.nan)  # of arcs; the empty state reads every word
        self.depth[index[0]] = 1
        self.weight[index[0][read]] = self.base[read]
        for k in range(1, order):
            at = np.flatnonzero(grams.exists[k])
            own, n = index[k][at], count[index[k - 1][at - 1]]
            chance[at] = np.where(n > 0, (count[own] + strength * chance[at]) / (n + strength), chance[at])
            seen = count[own] > 0
            self.weight[own[seen]] = np.log10(chance[at[seen]])
            suffix = self.next[index[k - 1][at]]
            self.shorter[own], self.depth[own] = suffix, k + 1
            if k == order - 1:  # the longest n-grams are no states: their arcs lead to the shorter ones
                self.next[own] = suffix
        self.to_fail = np.append(np.log10(strength / (count + strength)), 0.0)

    def read(self, state: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """States after reading the token at each place, and the weights of the arcs taken."""
        state, total = state.copy(), np.zeros(len(state))
        open_ = np.arange(len(state))
        while len(open_):
            arc = self.index[self.depth[state[open_]], place[open_]]
            weight = self.weight[arc]
            found = (arc >= 0) & ~np.isnan(weight)
            hit = open_[found]
            total[hit] += weight[found]
            state[hit] = self.next[arc[found]]
            open_ = open_[~found]
            total[open_] += self.to_fail[state[open_]]
            state[open_] = self.shorter[state[open_]]
        return state, total

    def scores(self, grams: Grams, count: np.ndarray, piece: int = PIECE) -> np.ndarray:
        """Log probability of every document."""
        tokens = grams.sizes - 1
        n = -(-tokens // piece)
        doc = np.repeat(np.arange(len(tokens)), n)
        begin = 1 + (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)) * piece
        end = np.minimum(begin + piece, grams.sizes[doc])
        at = grams.first[doc]
        start = self.index[0][at]
        # At a document's start the state is the start itself; a later piece reads the words before it.
        state = np.where((begin == 1) & (count[start] > 0) & (self.order > 1), start, _EMPTY)
        for back in range(self.order - 1, 0, -1):
            use = np.flatnonzero(begin - back >= 1)
            state[use], _ = self.read(state[use], at[use] + begin[use] - back)
        total = np.zeros(len(doc))
        open_ = np.arange(len(doc))
        for step in range(piece):
            open_ = open_[begin[open_] + step < end[open_]]
            if not len(open_):
                break
            state[open_], weights = self.read(state[open_], at[open_] + begin[open_] + step)
            total[open_] += weights
        return np.bincount(doc, total, len(tokens))


class _Counts:
    """What a block knows of its n-grams after some rounds of answers, and what it asks next.

    ``answers`` has the answers of each round; ``count`` is right for all n-grams that were asked about
    or need not be.
    """

    def __init__(self, grams: Grams, train: pa.ChunkedArray, answers: list[np.ndarray]):
        order = len(grams.keys)
        self.distinct, self.index = grams.indexed()
        learned = train.to_numpy().astype(bool)[grams.doc]
        self.local = np.bincount(self.index[grams.exists & learned], minlength=len(self.distinct))
        self.count = self.local.copy()
        size = self.distinct & _TAG
        self.asked = size <= 2
        shared = np.zeros(len(self.distinct), bool)
        for k, values in enumerate(answers, 2):
            local = self.local[self.asked]
            self.count[self.asked] = np.where(values == _LONE, local, values - (values > _LONE))
            shared[self.asked] = values > _LONE
            self.asked = np.zeros(len(self.distinct), bool)
            if k < order:
                at = np.flatnonzero(grams.exists[k])
                shorter = self.index[k - 1]
                self.asked[self.index[k][at]] = shared[shorter[at]] & shared[shorter[at - 1]]


def _rounds(messages: pa.Table) -> list[np.ndarray]:
    """Answers of all rounds so far."""
    numbers = messages["round"].to_numpy()
    return [exchange.answers(messages.filter(pa.array(numbers == r))).astype(np.int64)
            for r in range(int(numbers.max()) + 1)]


def _asking(order: int, n: int):
    def question(docs: pa.Table, block: int, answers: list[np.ndarray]) -> pa.Table:
        own = _Counts(Grams(docs["text"], order), docs["train"], answers)
        return exchange.question(block, own.distinct[own.asked], own.local[own.asked], n)

    def ask(key: tuple[pa.Scalar, ...], docs: pa.Table) -> pa.Table:
        return question(docs, key[0].as_py(), [])

    def ask_on(key: tuple[pa.Scalar, ...], docs: pa.Table, messages: pa.Table) -> pa.Table:
        return question(docs, key[0].as_py(), _rounds(messages))

    return ask, ask_on


def _answering(number: int):
    """0: not counted; ``_LONE``: counted in the block that asks, which alone has it; else count + 1."""

    def answer(messages: pa.Table) -> pa.Table:
        distinct, total, blocks, reply = exchange.gathered(messages)
        words = (distinct & _TAG) == 1
        values = np.where((blocks == 1) & (total > 0), _LONE, total + (total > 0)).astype(np.uint64)
        n = len(messages)
        return pa.table({
            "block": messages["block"], "range": messages["range"],
            "counts": pa.array([reply(i, values) for i in range(n)], pa.binary()),
            "round": pa.array(np.full(n, number), pa.int32()),
            "tokens": pa.array(np.full(n, total[words].sum(), np.int64)),
            "words": pa.array(np.full(n, (total[words] > 0).sum(), np.int64)),
        })

    return answer


def _scoring(order: int, strength: float):
    def score(docs: pa.Table, messages: pa.Table) -> pa.Table:
        grams = Grams(docs["text"], order)
        own = _Counts(grams, docs["train"], _rounds(messages))
        index, count = own.index, own.count.astype(np.float64)
        tokens, words = (sum(messages[c].to_pylist()) for c in ("tokens", "words"))
        automaton = Automaton(grams, index, count, tokens, words, strength)
        n_docs = len(grams.sizes)
        read = grams.place > 0
        known = read & (count[index[0]] > 0)
        return pa.table({
            "id": docs["id"], "train": docs["train"],
            "n_tokens": pa.array(grams.sizes - 1, pa.int64()),
            "n_known": pa.array(np.bincount(grams.doc[known], minlength=n_docs), pa.int64()),
            "train_tokens": pa.array(np.full(n_docs, tokens), pa.int64()),
            "base_score": pa.array(np.bincount(grams.doc, automaton.base, n_docs)),
            "score": pa.array(automaton.scores(grams, count)),
        })

    return score


def scored(docs: DataFrame, train: Column, id_column: str = "doc_id", text_column: str = "text",
           order: int = ORDER, strength: float = STRENGTH, block_bytes: int = exchange.BLOCK_BYTES,
           ) -> DataFrame:
    """``id``, ``train``, token counts, unigram ``base_score`` and ``score`` (log10) of every row.

    The model learns from the rows for which ``train`` holds.
    """
    flagged = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"),
                          F.coalesce(train, F.lit(False)).alias("train"))
    dealt, n = exchange.blocks_of(flagged, "id", "text", block_bytes)
    kind = flagged.schema["id"].dataType.simpleString()
    ask, ask_on = _asking(order, n)
    answers = None
    for number in range(max(1, order - 1)):
        own = dealt.groupBy("block")
        asked = own.cogroup(answers.groupBy("block")).applyInArrow(ask_on, exchange.ASKED) if answers else (
            own.applyInArrow(ask, exchange.ASKED))
        replies = asked.repartition(n, "range").groupBy("range").applyInArrow(_answering(number), ANSWERED)
        answers = answers.unionByName(replies) if answers else replies
    return dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        _scoring(order, strength),
        f"id {kind}, train boolean, n_tokens long, n_known long, train_tokens long, "
        "base_score double, score double")
