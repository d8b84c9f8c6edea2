"""Language identification of code-switched text by a linear-chain conditional random field.

Every word gets a distribution over languages by forward-backward; a text's language is the one with the
largest share of its words. A word's features are its affixes, the n-grams within it, the word itself and how
a lexicon of labelled texts splits it among the languages; transitions between languages are learned
with them.

The field is fitted on a bounded sample of labelled texts. Half of them make the lexicon, the others are cut
into pieces and joined into sequences that switch languages, so that transitions can be learned. The
sequences are few enough for one machine; all texts are labelled where they lie.

Long texts are no long loops: chains are cut into chunks, whose transfer matrices are computed side by
side and then joined, so the result is that of the whole chain.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quotidian.llm.scratch import stream_texts
from quotidian.llm.text import Texts, Words, byte_class, column, mix, pieces, nameable, range_names, sums, texts_of, words_of

#: Letters of lower-cased text: a-z and all bytes beyond ASCII.
LETTERS = byte_class(bytes([*range(0x61, 0x7B), *range(0x80, 0x100)]))
#: Labelled texts that the field is fitted on, languages taking turns, words used of each for sequences, and
#: letters of each that come to the driver.
FIT_TEXTS, FIT_WORDS, FIT_LETTERS = 1500, 120, 1 << 16
#: Hashes are counted by so many leading bits.
BIN_BITS = 13
#: Hashed features; words of a sequence, mean words before a switch; rounds of fitting.
FEATURES, SEQUENCE, STRETCH, ROUNDS = 1 << 16, 40, 14, 40
CHUNK = 64


@dataclass
class Field:
    languages: list[str]
    weights: np.ndarray  # features x languages
    transitions: np.ndarray  # log weights, from x to
    lexicon: np.ndarray  # sorted names of words
    shares: np.ndarray  # log shares of the lexicon's words
    lexical: np.ndarray  # weight of a share in one language for another


def features(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(feature, word) of all features of words, ordered by word, and the words' names."""
    padded = nameable(data)
    names = range_names(padded, starts, ends)
    size = ends - starts
    every = np.arange(len(starts))
    found, owner = [names], [every]
    for n in (1, 2, 3):
        long = size >= n
        for kind, low in ((0, starts[long]), (1, ends[long] - n)):
            found.append(mix(range_names(padded, low, low + n) + np.uint64(8 * n + kind + 1)))
            owner.append(every[long])
    for n in (2, 3, 4):
        count = np.maximum(size - n + 1, 0)
        first = np.cumsum(count) - count
        low = np.arange(int(count.sum())) + np.repeat(starts - first, count)
        found.append(mix(range_names(padded, low, low + n) + np.uint64(8 * n + 3)))
        owner.append(np.repeat(every, count))
    where = np.concatenate(owner)
    order = np.argsort(where, kind="stable")
    return (np.concatenate(found)[order] % np.uint64(FEATURES)).astype(np.int64), where[order], names


def distinct_words(texts: Texts) -> tuple[Words, np.ndarray, np.ndarray, Texts]:
    """The texts' words; the first place of each distinct one, and which one each word is; lower-cased."""
    lower = texts.lower()
    words = words_of(lower, LETTERS)
    names = range_names(nameable(lower.data), words.starts, words.ends)
    _, first, which = np.unique(names, return_index=True, return_inverse=True)
    return words, first, which, lower


def shares_of(field_lexicon: np.ndarray, shares: np.ndarray, names: np.ndarray) -> np.ndarray:
    if not len(field_lexicon):
        return np.zeros((len(names), shares.shape[1]))
    at = np.minimum(np.searchsorted(field_lexicon, names), len(field_lexicon) - 1)
    return np.where((field_lexicon[at] == names)[:, None], shares[at], 0.0)


def chain(emit: np.ndarray, transitions: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Marginals of all labels. emit and transitions hold log weights; bounds cut the words into chains."""
    n, k = emit.shape
    if not n:
        return emit
    t = np.exp(transitions - transitions.max())
    e = np.exp(emit - emit.max(1, keepdims=True))
    counts = np.diff(bounds)
    chunks = -(-counts // CHUNK)
    chain_of = np.repeat(np.arange(len(counts)), chunks)
    number = np.arange(len(chain_of)) - np.repeat(np.cumsum(chunks) - chunks, chunks)
    start = bounds[:-1][chain_of] + CHUNK * number
    size = np.minimum(bounds[1:][chain_of] - start, CHUNK)
    place = np.minimum(start[:, None] + np.arange(CHUNK), n - 1)
    inside = np.arange(CHUNK) < size[:, None]
    steps = e[place]
    # Transfer matrices of chunks: from each label before to each label of the last word.
    move = np.broadcast_to(np.eye(k), (len(start), k, k)).copy()
    for j in range(CHUNK):
        on = inside[:, j]
        if not on.any():
            break
        after = (move[on] @ t) * steps[on, j][:, None, :]
        move[on] = after / after.max((1, 2), keepdims=True)
    before, behind = np.empty((len(start), k)), np.empty((len(start), k))
    first = np.cumsum(chunks) - chunks
    head = np.full((len(counts), k), 1.0 / k)
    tail = np.ones((len(counts), k))
    for step in range(int(chunks.max())):
        live = np.flatnonzero(chunks > step)
        at = first[live] + step
        before[at] = head[live]
        new = np.einsum("ck,ckl->cl", head[live], move[at])
        head[live] = new / new.sum(1, keepdims=True)
        at = first[live] + chunks[live] - 1 - step
        behind[at] = tail[live]
        new = np.einsum("ckl,cl->ck", move[at], tail[live])
        tail[live] = new / new.sum(1, keepdims=True)
    out = np.empty((n, k))
    forward = np.empty((len(start), CHUNK, k))
    a = before
    for j in range(CHUNK):
        new = (a @ t) * steps[:, j]
        a = np.where(inside[:, j, None], new / new.sum(1, keepdims=True), a)
        forward[:, j] = a
    b = behind
    for j in range(CHUNK - 1, -1, -1):
        on = inside[:, j]
        both = forward[on, j] * b[on]
        out[place[on, j]] = both / both.sum(1, keepdims=True)
        new = (steps[on, j] * b[on]) @ t.T
        b = b.copy()
        b[on] = new / new.sum(1, keepdims=True)
    return out


# Fitting ------------------------------------------------------------------------------------------------


def fitting_rows(docs: DataFrame, texts: int = FIT_TEXTS) -> list[tuple[str, str]]:
    """(lang, text) of at most `texts` labelled texts with a letter outside the fold that is held out, and of each
    at most FIT_LETTERS. They are chosen by a hash of their doc_id, languages taking turns; only ids are shuffled for that."""
    labelled = docs.where("lang IS NOT NULL AND NOT held_out AND has_letter")
    hashed = labelled.select("lang", "doc_id", F.xxhash64("doc_id").alias("hash")).withColumn("bin", F.shiftright("hash", 64 - BIN_BITS))
    # The bins of hashes that hold a language's first `texts` rows; only these rows are ranked.
    before = F.sum("n").over(Window.partitionBy("lang").orderBy("bin")) - F.col("n")
    bins = hashed.groupBy("lang", "bin").agg(F.count("*").alias("n")).withColumn("before", before)
    last = bins.where(F.col("before") < texts).groupBy("lang").agg(F.max("bin").alias("last"))
    # The first turn alone takes all there is room for from the first languages by name; no more are broadcast.
    last = F.broadcast(last.orderBy("lang").limit(texts))
    order = Window.partitionBy("lang").orderBy("hash")
    chosen = (
        hashed.join(last, "lang").where(F.col("bin") <= F.col("last"))
        .withColumn("turn", F.row_number().over(order)).where(F.col("turn") <= texts)
        .orderBy("turn", "lang", "hash").limit(texts).select("lang", "doc_id").distinct()
    )
    here = F.broadcast(chosen.select(F.col("lang").alias("its_lang"), F.col("doc_id").alias("its_id")))
    rows = labelled.join(here, F.col("doc_id").eqNullSafe(F.col("its_id")) & (F.col("lang") == F.col("its_lang")), "left_semi")
    order = (F.xxhash64("doc_id"), F.xxhash64("text"), F.col("lang"))
    found = rows.orderBy(*order).limit(texts).select("lang", F.substring("text", 1, FIT_LETTERS).alias("text"))
    return [(r["lang"], r["text"]) for r in found.toLocalIterator()]


def _pass_over(emit: np.ndarray, transitions: np.ndarray, gold: np.ndarray, sequences: int):
    """Gradients of the log likelihood of sequences of one length: by emission, by transition."""
    length, k = len(gold) // sequences, emit.shape[1]
    t = np.exp(transitions - transitions.max())
    e = np.exp(emit - emit.max(1, keepdims=True)).reshape(sequences, length, k)
    alpha, beta = np.empty_like(e), np.ones_like(e)
    a = np.full((sequences, k), 1.0 / k)
    for j in range(length):
        a = (a @ t) * e[:, j]
        a /= a.sum(1, keepdims=True)
        alpha[:, j] = a
    for j in range(length - 1, 0, -1):
        b = (e[:, j] * beta[:, j]) @ t.T
        beta[:, j - 1] = b / b.sum(1, keepdims=True)
    marginal = alpha * beta
    marginal /= marginal.sum(2, keepdims=True)
    pair = alpha[:, :-1, :, None] * t * (e[:, 1:] * beta[:, 1:])[:, :, None, :]
    pair /= pair.sum((2, 3), keepdims=True)
    y = gold.reshape(sequences, length)
    by_transition = -pair.sum((0, 1))
    np.add.at(by_transition, (y[:, :-1].ravel(), y[:, 1:].ravel()), 1)
    by_emission = -marginal.reshape(-1, k)
    by_emission[np.arange(len(gold)), gold] += 1
    return by_emission, by_transition


def fit(rows: list[tuple[str, str]], seed: int = 7) -> Field | None:
    """Deterministic for given rows. None without rows."""
    languages = sorted({lang for lang, _ in rows})
    if not languages:
        return None
    k, rng = len(languages), np.random.default_rng(seed)
    label = np.array([languages.index(lang) for lang, _ in rows])
    texts = texts_of(pa.array([text for _, text in rows], pa.string()))
    words, first, which, lower = distinct_words(texts)
    names = range_names(nameable(lower.data), words.starts[first], words.ends[first])
    owner_of_word = words.owner()

    # Lexicon of every second text: words met twice or more.
    in_lexicon = owner_of_word % 2 == 0
    table = np.bincount(
        which[in_lexicon] * k + label[owner_of_word[in_lexicon]], minlength=len(first) * k).reshape(-1, k)
    common = np.flatnonzero(table.sum(1) >= 2)
    shares = np.log((table[common] + 0.5) / (table[common] + 0.5).sum(1, keepdims=True)) + np.log(k)
    order = np.argsort(names[common])
    lexicon, shares = names[common][order], shares[order]

    # Sequences of stretches of the other texts, in random order (of all, where there are too few).
    pool = []
    fitted = [i for i in range(len(rows)) if i % 2 or len(rows) < 20]
    for i in fitted:
        low, high = words.bounds[i], words.bounds[i + 1]
        if high > low:
            begin = low + int(rng.integers(0, max(high - low - FIT_WORDS, 0) + 1))
            at, stop = begin, min(begin + FIT_WORDS, high)
            while at < stop:
                size = int(min(rng.geometric(1 / STRETCH), stop - at))
                pool.append((at, at + size, label[i]))
                at += size
    mixed = [pool[i] for i in rng.permutation(len(pool))]
    seq = np.concatenate([np.arange(a, b) for a, b, _ in mixed])
    gold = np.concatenate([np.full(b - a, y) for a, b, y in mixed])
    length = min(SEQUENCE, len(seq))
    count = len(seq) // length
    seq, gold = which[seq[: count * length]], gold[: count * length]

    # From here on only the sequences' words and features count.
    used, seq = np.unique(seq, return_inverse=True)
    feature, owner, _ = features(lower.data, words.starts[first[used]], words.ends[first[used]])
    there, feature = np.unique(feature, return_inverse=True)
    bounds = np.searchsorted(owner, np.arange(len(used) + 1))
    share_of_word = shares_of(lexicon, shares, names[used])
    params = [np.zeros((len(there), k)), np.zeros((k, k)), np.zeros((k, k))]
    first_moment, second_moment = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, ROUNDS + 1):
        weights, transitions, lexical = params
        by_word = np.stack([sums(weights[feature, j], bounds) for j in range(k)], axis=1) + share_of_word @ lexical
        g_emit, g_move = _pass_over(by_word[seq], transitions, gold, count)
        g_word = np.stack([np.bincount(seq, g_emit[:, j], len(used)) for j in range(k)], axis=1)
        g_weights = np.stack([np.bincount(feature, g_word[owner, j], len(there)) for j in range(k)], axis=1)
        grads = [g_weights - 0.5 * weights, g_move - 0.5 * transitions, share_of_word.T @ g_word - 0.5 * lexical]
        for p, g, m, v in zip(params, grads, first_moment, second_moment):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p += 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    _, transitions, lexical = params
    weights = np.zeros((FEATURES, k), np.float32)
    weights[there] = params[0]
    return Field(languages, weights, transitions, lexicon, shares, lexical)


def label_words(texts: Texts, field: Field) -> tuple[Words, np.ndarray]:
    """The texts' words and the distribution over languages of each."""
    words, first, which, lower = distinct_words(texts)
    k = len(field.languages)
    if not len(words):
        return words, np.zeros((0, k))
    feature, owner, names = features(lower.data, words.starts[first], words.ends[first])
    bounds = np.searchsorted(owner, np.arange(len(first) + 1))
    by_word = np.stack([sums(field.weights[feature, j].astype(np.float64), bounds) for j in range(k)], axis=1)
    by_word += shares_of(field.lexicon, field.shares, names) @ field.lexical
    return words, chain(by_word[which], field.transitions, words.bounds)


def spans(marginal: np.ndarray, languages: list[str]) -> list[dict]:
    """Runs of words of one language."""
    if not len(marginal):
        return []
    best = marginal.argmax(1)
    cut = np.flatnonzero(np.diff(best, prepend=-1))
    return [{"first_word": int(a), "end_word": int(b), "lang": languages[best[a]]}
            for a, b in zip(cut, np.append(cut[1:], len(best)))]


def identify(docs: DataFrame, folds: int = 3, held: int = 1, texts: int = FIT_TEXTS) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, spans) of every row.

    Learned from text and lang of rows that aren't held out (crc32 of the doc_id as text mod folds is `held`;
    rows without a doc_id aren't), at most `texts` of them. lang_pred: the language with the largest
    share of words, the first by name of those that tie; score: that share. A null text and one without a
    letter are `und` with score 0, as is all text where no language could be learned. spans: runs of
    words of one language. Repeated rows get equal results; an empty table gives no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang").withColumns({
        "held_out": F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds == held, F.lit(False)),
        "has_letter": F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)),
    })
    field = docs.sparkSession.sparkContext.broadcast(fit(fitting_rows(rows, texts)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = field.value
        for batch in batches:
            for piece, texts in pieces(batch, "text"):
                letters = np.asarray(column(piece, "has_letter").to_numpy(zero_copy_only=False), bool)
                pred, share, runs = ["und"] * len(texts), np.zeros(len(texts)), [[] for _ in range(len(texts))]
                if model is not None:
                    words, marginal = label_words(texts, model)
                    total = np.stack([sums(marginal[:, j], words.bounds) for j in range(marginal.shape[1])], axis=1)
                    for i in np.flatnonzero(letters & (words.counts > 0)):
                        best = int(total[i].argmax())
                        pred[i] = model.languages[best]
                        share[i] = min(max(total[i, best] / words.counts[i], 0.0), 1.0)
                        runs[i] = spans(marginal[words.bounds[i] : words.bounds[i + 1]], model.languages)
                yield pa.RecordBatch.from_arrays([
                    column(piece, "doc_id"), column(piece, "held_out"), pa.array(pred, pa.string()), pa.array(share),
                    pa.array(runs, _SPANS),
                ], ["doc_id", "held_out", "lang_pred", "score", "spans"])

    return stream_texts(rows.drop("lang")).mapInArrow(
        run, "doc_id long, held_out boolean, lang_pred string, score double, "
             "spans array<struct<first_word: int, end_word: int, lang: string>>")


_SPANS = pa.list_(pa.struct([("first_word", pa.int32()), ("end_word", pa.int32()), ("lang", pa.string())]))
