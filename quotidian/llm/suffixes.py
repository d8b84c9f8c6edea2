"""Substring dedup of bytes: suffix buckets sorted one at a time over a difference cover.

Only suffixes that may repeat are sorted. Three exchanges find and settle them:

1. Every window shares its anchor (see anchors.py) with any equal window. Anchors that only one document has
   end here, and with them most of the text.
2. The contexts of shared anchors are named. A context that a smaller doc_id has too is removed whole, so
   copies collapse. Of each context the document with the smallest doc_id remains.
3. What remains is sent once, grouped by anchor, and sorted blockwise: in each task the contexts of a range
   of anchors make up a text in which all anchors lie at multiples of COVER; the suffixes at the places of
   a difference cover modulo COVER are ranked first; then one bucket of suffixes after another is sorted by
   its first 16 bytes and longer ties by the rank at the next cover place. Neighbours that agree in a
   whole window are repeats of the smallest doc_id among them. A task holds one bucket besides its text.

An anchor that very many documents have, with ever different surroundings, is not gathered: the windows in
what remains of such anchors' contexts are named one by one and compared by name in the third exchange, to
which a piece sends only its smallest doc_id with each. Which anchors these are is estimated on SAMPLE documents; it changes the way, not the result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotidian.llm.anchors import K, anchors, contexts, fixed_names
from quotidian.llm.scratch import id_and_text, stream_texts, unzipped, zipped
from quotidian.llm.seen import bucket_count, by_bucket, doc_bucket, heads_of, joined, packed, seen, told
from quotidian.llm.text import Texts, column, hash_words, ints, pieces

WINDOW = 50
#: The cover's modulus: two lanes of 8 bytes.
COVER = 16
#: Suffixes sorted at once.
BLOCK = 1 << 19
#: Documents on which crowded anchors are looked for, and how many of them make an anchor crowded. At most
#: SAMPLE x (anchors per document) / CROWD names are broadcast, 8 bytes each.
SAMPLE, CROWD = 20_000, 20


def difference_cover(modulus: int) -> list[int]:
    """Residues whose differences are all residues, chosen greedily."""
    cover = [0]
    missing = set(range(1, modulus))
    while missing:
        def gain(c: int) -> int:
            return len(missing & ({(c - x) % modulus for x in cover} | {(x - c) % modulus for x in cover}))

        best = max((c for c in range(modulus) if c not in cover), key=gain)
        missing -= {(best - x) % modulus for x in cover} | {(x - best) % modulus for x in cover}
        cover.append(best)
    return sorted(cover)


# Sorting ----------------------------------------------------------------------------------------------


def sort_bucket(lanes: list[np.ndarray], start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the suffixes that tie on all keys but the last, in order, and a label of each such tie.
    The first key is a class, the others are compared one after another; who ties with nobody is out."""
    live = np.arange(len(start))
    label = np.zeros(len(start), np.int64)
    for key in lanes[:-1]:
        order = np.lexsort((key[live], label))
        live, label = live[order], label[order]
        value = key[live]
        new = np.ones(len(live), bool)
        new[1:] = (value[1:] != value[:-1]) | (label[1:] != label[:-1])
        tied = ~(new & np.append(new[1:], True))
        label = np.cumsum(new)[tied]
        live = live[tied]
    order = np.lexsort((lanes[-1][live], label))
    return live[order], label[order]


def repeated_windows(
    blob: np.ndarray, left: np.ndarray, right: np.ndarray, anchor: np.ndarray, doc: np.ndarray, window: int,
) -> tuple[np.ndarray, np.ndarray]:
    """(context, offset) of the windows that a context of the same anchor with a smaller doc also has.

    blob holds each context's `left` bytes before and `right` bytes behind its anchor, in the order of
    anchors. The anchor itself is equal in all and left out, so a window is window - K bytes here.
    Contexts are worked through in blocks of whole anchors with about BLOCK windows; only a block's text
    and ranks are in memory.
    """
    count = np.maximum(left + right - (window - K) + 1, 0)
    count = np.minimum(count, left + 1)
    total = np.concatenate([[0], np.cumsum(count)])
    first = np.concatenate([[0], np.cumsum(left + right)])
    heads = heads_of(anchor) if len(anchor) else np.zeros(0, np.int64)
    ends = np.append(heads[1:], len(anchor))
    found_c, found_o = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    low = 0
    while low < len(heads):
        high = max(int(np.searchsorted(total[ends], total[heads[low]] + BLOCK, "right")), low + 1)
        a, b = heads[low], ends[high - 1]
        who, offset = _repeated_in_block(
            blob[first[a] : first[b]], left[a:b], right[a:b], anchor[a:b], doc[a:b], count[a:b], window - K)
        found_c.append(who + a)
        found_o.append(offset)
        low = high
    return np.concatenate(found_c), np.concatenate(found_o)


def _repeated_in_block(blob, left, right, anchor, doc, count, size) -> tuple[np.ndarray, np.ndarray]:
    none = np.zeros(0, np.int64)
    if not count.any():
        return none, none
    room = -(-size // COVER) * COVER
    slot = -(-(room + size + 24) // COVER) * COVER
    n = len(left)
    text = np.zeros(n * slot + 64, np.uint8)
    base = np.arange(n) * slot + room
    length = left + right
    first = np.cumsum(length) - length
    text[np.arange(int(length.sum())) + np.repeat(base - left - first, length)] = blob
    # Cover-sample ranks: by the 32 bytes from each place on, more than a window's rest.
    quads = np.ndarray(len(text) - 7, ">u8", text, 0, (1,))
    cover = np.array(difference_cover(COVER))
    places = (np.arange(n * slot // COVER)[:, None] * COVER + cover).ravel()
    keys = [quads[places + 8 * k].astype(np.uint64) for k in range(4)]
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    for k in keys:
        new[1:] |= k[order][1:] != k[order][:-1]
    rank = np.zeros(len(text), np.int32)
    rank[places[order]] = np.cumsum(new)
    ahead = np.array([min((c - r) % COVER for c in cover) for r in range(COVER)])

    # A window holds the whole anchor, so it begins at most `left` bytes before it.
    who = np.repeat(np.arange(n), count)
    offset = np.arange(len(who)) - np.repeat(np.cumsum(count) - count, count)
    start = base[who] - left[who] + offset
    group = np.cumsum(np.diff(anchor, prepend=anchor[:1]) != 0)
    kind = group[who] * slot + (left[who] - offset)
    live, label = sort_bucket(
        [kind, quads[start].astype(np.uint64), quads[start + 8].astype(np.uint64),
         rank[start + ahead[start % COVER]]], start)
    if not len(live):
        return none, none
    s = start[live]
    same = label[1:] == label[:-1]
    for k in [*range(16, size - 7, 8), size - 8]:
        same &= quads[s[1:] + k] == quads[s[:-1] + k]
    head = np.flatnonzero(~np.concatenate([[False], same]))
    of = doc[who[live]]
    least = np.repeat(np.minimum.reduceat(of, head), np.diff(np.append(head, len(of))))
    later = of > least
    return who[live][later], offset[live][later]


# Exchanges ----------------------------------------------------------------------------------------------


def _anchor_entries(window: int):
    def entries(piece: pa.RecordBatch, texts: Texts):
        place, names = anchors(texts, window)
        return [(np.searchsorted(texts.bounds, place, "right") - 1, names)]

    return entries


def crowded_anchors(docs: DataFrame, window: int) -> np.ndarray:
    """Names of anchors that at least CROWD of about SAMPLE documents have."""
    step = max(1, docs.count() // SAMPLE)
    chosen = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(step)) == 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece, texts in pieces(batch, "text"):
                owner, names = _anchor_entries(window)(piece, texts)[0]
                pairs = np.unique(np.stack([names, owner.astype(np.uint64)], axis=1), axis=0)[:, 0]
                found, count = np.unique(pairs, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(count)], ["name", "n"])

    counted = stream_texts(chosen.select("text")).mapInArrow(run, "name long, n long").groupBy("name").agg(F.sum("n").alias("n"))
    rows = counted.where(F.col("n") >= CROWD).select("name").collect()
    return np.sort(np.array([r["name"] for r in rows], np.int64).view(np.uint64))


def _shared(piece: pa.RecordBatch, texts: Texts, window: int):
    """Anchors that other documents have too: (text, place, name, begin, end, context's name)."""
    place, names = anchors(texts, window)
    owner = np.searchsorted(texts.bounds, place, "right") - 1
    keep = told(piece, "shared", owner, names, any_other=True)
    place, names = place[keep], names[keep]
    owner, low, high = contexts(texts, place, window)
    context = np.zeros(len(place), np.uint64)
    whole = high - low == 2 * window - K
    context[whole] = fixed_names(texts.data, low[whole], 2 * window - K)
    context[~whole] = hash_words(texts.data, low[~whole], high[~whole])
    # The anchor's place tells apart contexts that are cut off by an end of a text.
    context += (place - low).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return owner, place, names, low, high, context


def _context_entries(window: int):
    def entries(piece: pa.RecordBatch, texts: Texts):
        owner, _, _, _, _, context = _shared(piece, texts, window)
        return [(owner, context)]

    return entries


def _windows(texts: Texts, low: np.ndarray, high: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(begin, name) of the windows in these stretches."""
    count = np.maximum(high - low - window + 1, 0)
    at = np.arange(int(count.sum())) + np.repeat(low - (np.cumsum(count) - count), count)
    at = np.unique(at)
    return at, fixed_names(texts.data, at, window)


#: What a row of the last exchange holds.
CONTEXTS, SPANS, WINDOWS = 0, 1, 2
_SENT = "bucket int, kind int, docs binary, begins binary, ends binary, names binary, sizes binary, blob binary"
_ARROW = pa.schema([("bucket", pa.int32()), ("kind", pa.int32()), *[(c, pa.binary()) for c in (
    "docs", "begins", "ends", "names", "sizes", "blob")]])


def _merged(doc: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans of each doc, in order, those that touch made one."""
    if not len(doc):
        return doc, low, high
    order = np.lexsort((low, doc))
    doc, low, high = doc[order], low[order], high[order]
    # Ends only grow within a doc; an offset per doc keeps docs apart.
    part = np.cumsum(np.diff(doc, prepend=doc[:1]) != 0) * (np.int64(1) << 40)
    reach = np.maximum.accumulate(high + part)
    new = np.ones(len(doc), bool)
    new[1:] = low[1:] + part[1:] > reach[:-1]
    head = np.flatnonzero(new)
    last = np.append(head[1:], len(doc)) - 1
    return doc[head], low[head], reach[last] - part[last]


def _spans(doc: np.ndarray, low: np.ndarray, high: np.ndarray, buckets: int) -> pa.RecordBatch:
    """Rows of spans, on the way to where a document's spans are gathered."""
    doc, low, high = _merged(doc, low, high)
    at, columns = packed(doc_bucket(doc, buckets), doc, low, high)
    return _sent(SPANS, at, **dict(zip(("docs", "begins", "ends"), columns)))


def _sent(kind: int, bucket: np.ndarray, **columns: list[bytes]) -> pa.RecordBatch:
    none = pa.nulls(len(bucket), pa.binary())
    return pa.RecordBatch.from_arrays([
        pa.array(bucket, pa.int32()), pa.array(np.full(len(bucket), kind, np.int32)),
        *[pa.array(columns[f.name], pa.binary()) if f.name in columns else none for f in list(_ARROW)[2:]],
    ], schema=_ARROW)


def with_spans(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, text, spans): docs, their texts zipped, with the byte ranges that windows of smaller doc_ids
    cover, as packed pairs."""
    spark = docs.sparkSession
    plain = zipped(docs)
    buckets = bucket_count(id_and_text(docs))
    crowd = spark.sparkContext.broadcast(crowded_anchors(id_and_text(docs), window))
    # Left joins of one and the same table, so that its exchange is made once and read again.
    shared = seen(plain, _anchor_entries(window), buckets, shared=True)
    first = plain.join(shared, "doc_id", "left")
    smaller = seen(first, _context_entries(window), buckets, smaller=False)
    second = first.join(smaller, "doc_id", "left")

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece, texts in (x for part in unzipped(batch) for x in pieces(part, "text")):
                owner, place, names, low, high, context = _shared(piece, texts, window)
                ids = ints(piece, "doc_id")
                whole = high - low >= window
                gone = told(piece, "smaller", owner, context) & whole
                hot = np.isin(names, crowd.value) & whole & ~gone
                # Of the windows of crowded anchors the piece settles what it can.
                at, name = _windows(texts, low[hot], high[hot], window)
                of = np.searchsorted(texts.bounds, at, "right") - 1
                if len(at):
                    order = np.argsort(name, kind="stable")
                    at, of, name = at[order], of[order], name[order]
                    heads = heads_of(name)
                    least = np.minimum.reduceat(ids[of], heads)
                    over = ids[of] > np.repeat(least, np.diff(np.append(heads, len(name))))
                    sent = np.flatnonzero(~over)
                    bucket, (docs_, begins_, names_) = packed(
                        (name[sent] % np.uint64(buckets)).astype(np.int64), ids[of[sent]],
                        at[sent] - texts.bounds[of[sent]], name[sent])
                    yield _sent(WINDOWS, bucket, docs=docs_, begins=begins_, names=names_)
                    at, of = at[over], of[over]
                begin, end = np.concatenate([low[gone], at]), np.concatenate([high[gone], at + window])
                mine = np.concatenate([owner[gone], of])
                yield _spans(ids[mine], begin - texts.bounds[mine], end - texts.bounds[mine], buckets)

                order = np.flatnonzero(whole & ~gone & ~hot)
                bucket = (names[order] % np.uint64(buckets)).astype(np.int64)
                by = np.lexsort((ids[owner[order]], bucket))
                order, bucket = order[by], bucket[by]
                owner, place, names, low, high = (x[order] for x in (owner, place, names, low, high))
                # Both sides of each anchor, one context after another.
                left, right = place - low, high - place - K
                size = left + right
                first = np.cumsum(size) - size
                offset = np.arange(int(size.sum())) - np.repeat(first, size)
                skip = np.where(offset >= np.repeat(left, size), K, 0)
                blob = texts.data[np.repeat(low, size) + offset + skip]
                cuts = np.append(first, len(blob))[np.append(heads_of(bucket), len(bucket))] if len(bucket) else []
                blobs = [blob[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]
                bucket, (docs_, begins_, names_, sizes_) = packed(
                    bucket, ids[owner], low - texts.bounds[owner], names, np.stack([left, right], 1).astype(np.uint8))
                yield _sent(CONTEXTS, bucket, docs=docs_, begins=begins_, names=names_, sizes=sizes_, blob=blobs)

    def sort(table: pa.Table) -> pa.Table:
        done = table.filter(pc.equal(table["kind"], SPANS)).cast(_ARROW)
        single = table.filter(pc.equal(table["kind"], WINDOWS))
        sent = table.filter(pc.equal(table["kind"], CONTEXTS))
        names, doc, begin = joined(single["names"], np.uint64), joined(single["docs"], np.int64), joined(single["begins"], np.int64)
        out = [done]
        if len(names):
            order = np.argsort(names, kind="stable")
            names, doc, begin = names[order], doc[order], begin[order]
            heads = heads_of(names)
            later = doc > np.repeat(np.minimum.reduceat(doc, heads), np.diff(np.append(heads, len(names))))
            out.append(pa.Table.from_batches([_spans(doc[later], begin[later], begin[later] + window, buckets)], _ARROW))
        names, doc, begin = joined(sent["names"], np.uint64), joined(sent["docs"], np.int64), joined(sent["begins"], np.int64)
        sizes, data = joined(sent["sizes"], np.uint8).reshape(-1, 2).astype(np.int64), joined(sent["blob"], np.uint8)
        # An anchor with one context has nothing to be compared with.
        order = np.argsort(names, kind="stable")
        new = np.ones(len(names), bool)
        new[1:] = names[order][1:] != names[order][:-1]
        order = order[~(new & np.append(new[1:], True))]
        length = sizes.sum(1)
        first = np.cumsum(length) - length
        take = length[order]
        place = np.arange(int(take.sum())) + np.repeat(first[order] - (np.cumsum(take) - take), take)
        who, offset = repeated_windows(data[place], sizes[order, 0], sizes[order, 1], names[order], doc[order], window)
        low = begin[order][who] + offset
        mine = _spans(doc[order][who], low, low + window, buckets)
        return pa.concat_tables([*out, pa.Table.from_batches([mine], _ARROW)])

    def gather(table: pa.Table) -> pa.Table:
        doc, low, high = _merged(*(joined(table[c], np.int64) for c in ("docs", "begins", "ends")))
        heads = heads_of(doc) if len(doc) else np.zeros(0, np.int64)
        pairs = np.stack([low, high], axis=1)
        return pa.table({"doc_id": pa.array(doc[heads], pa.int64()), "spans": pa.array(
            [pairs[a:b].tobytes() for a, b in zip(heads, np.append(heads[1:], len(doc)))], pa.binary())})

    sorted_ = by_bucket(stream_texts(second).mapInArrow(send, _SENT), buckets).applyInArrow(sort, _SENT)
    spans = by_bucket(sorted_, buckets).applyInArrow(gather, "doc_id long, spans binary")
    return plain.join(spans, "doc_id", "left")


def dedup(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept) of every row; kept holds the bytes that stay.

    A byte goes if a string of `window` bytes that covers it also starts in a document with a smaller doc_id.
    A null text is empty. Rows that share a doc_id are one document: none of them is smaller, and each
    is judged by itself. Nothing is removed for or from rows without a doc_id. An empty table gives no rows.
    Equal anchors and contexts are told by 64-bit names. `window` is K + 16 to K + 255.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece, texts in (x for part in unzipped(batch) for x in pieces(part, "text")):
                sizes = np.diff(texts.bounds)
                removed, spans, kept = [], [], []
                for i, pairs in enumerate(column(piece, "spans").to_pylist()):
                    text = texts.text(i)
                    ranges = np.frombuffer(pairs or b"", np.int64).reshape(-1, 2)
                    change = np.zeros(len(text) + 1, np.int64)
                    np.add.at(change, ranges[:, 0], 1)
                    np.add.at(change, ranges[:, 1], -1)
                    gone = np.cumsum(change)[:-1] > 0
                    removed.append(int(gone.sum()))
                    spans.append(int((np.diff(gone, prepend=False) & gone).sum()))
                    kept.append(np.frombuffer(text, np.uint8)[~gone].tobytes() if removed[-1] else text)
                yield pa.RecordBatch.from_arrays([
                    column(piece, "doc_id"), pa.array(sizes), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()),
                    pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()), pa.array(kept, pa.binary()),
                ], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return stream_texts(with_spans(docs, window)).mapInArrow(
        run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")


def digests(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    return dedup(docs, window).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
