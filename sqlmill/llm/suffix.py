"""Suffix-array dedup of byte strings that earlier documents hold too.

Each byte of a text (UTF-8) is removed that lies in a ``LENGTH``-byte string
which also starts in a document with a smaller id; strings are judged on the
input.  Bytes that repeat come out by suffix arrays, built by grouping: suffixes
are grouped by their Lyndon prefix, groups are processed from the largest to
the smallest along pointers to the previous smaller suffix, and one pass over
the groups then emits the order.  Nothing is renamed or sorted recursively.

Which strings meet in one suffix array follows from anchors: of the hashed
``GRAM``-byte strings inside any ``LENGTH``-byte window the smallest is its
anchor, so equal windows share their anchor at the same place.  Grams that
occur in one document only are dropped after a packed exchange over all texts.
The windows of the other anchors go, as pieces of text, to the bucket of their
gram; equal pieces are collapsed first, and windows whose hash no other piece
of the gram has are left out, as they occur once.  The distinct rest is sorted
by one suffix array per bucket; runs of suffixes that share ``LENGTH`` bytes are the
classes of equal windows, and the smallest document of each class keeps its.

Hot strings: within a part of the documents only the smallest document with a
piece sends it, the others know by then that it repeats.  Windows around a gram
of very many documents (found exactly, their number is bounded) go to buckets
by their own bytes instead, one by one, so no gram fills a bucket.

Edge cases: a null text counts as empty; texts under ``LENGTH`` bytes stay
whole; rows without an id stay whole and remove nothing; rows that repeat an id
are one document in two pieces, each judged by its own text; an empty table
gives no rows; further columns are not read (``without_repeats`` returns them);
a very long text lies in one part, so a part may be as large as it.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator
from operator import itemgetter

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import repeated as R
from .common import python_ready, stored, tidy

LENGTH = 50
GRAM = 24
#: Most bytes before and after the start of an anchor that its windows reach.
BEFORE, AFTER = LENGTH - GRAM, LENGTH
#: Bytes of text that one part of the documents holds, about.
PART_BYTES = 8 << 20
_MULT = 0x9E3779B97F4A7C15
_BYTE = R.mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(_MULT))


# --- suffix array ----------------------------------------------------------

def suffix_array(text: bytes | list[int]) -> list[int]:
    """Starts of the suffixes of ``text`` in ascending order (a suffix is larger than its own beginnings)."""
    n = len(text)
    # the end counts as one more character, smaller than all others
    heads: dict[int, list[int]] = {}
    for i, c in enumerate(text):
        heads.setdefault(c, []).append(i)
    members: list = [{n}]
    below: list[int] = [-1]
    above: list[int] = [-1]
    group = [0] * (n + 1)
    for c in sorted(heads):
        g = len(members)
        for i in heads[c]:
            group[i] = g
        members.append(set(heads[c]))
        below.append(g - 1)
        above[g - 1] = g
        above.append(-1)
    # groups from the largest down: what points at a smaller suffix before it makes that one's prefix longer
    smaller = [-1] * (n + 1)
    done = bytearray(n + 1)
    g = len(members) - 1
    while g > 0:
        times: dict[int, int] = {}
        for i in sorted(members[g]):
            j = i - 1
            while j >= 0 and done[j]:
                j = smaller[j]
            smaller[i] = j
            done[i] = 1
            if j >= 0:
                times[j] = times.get(j, 0) + 1
        if times:
            by_times: dict[int, dict[int, list[int]]] = {}
            for j, k in times.items():
                by_times.setdefault(k, {}).setdefault(group[j], []).append(j)
            for k in sorted(by_times, reverse=True):
                for old, moved in by_times[k].items():
                    if len(moved) == len(members[old]):
                        continue  # the whole group moves: its place among the others stays
                    new = len(members)
                    members[old].difference_update(moved)
                    members.append(set(moved))
                    below.append(old)
                    above.append(above[old])
                    if above[old] >= 0:
                        below[above[old]] = new
                    above[old] = new
                    for j in moved:
                        group[j] = new
        g = below[g]
    # emit: going up the order, each suffix places the ones before it that lead to it
    place, at, g = [0] * len(members), 0, 0
    while g >= 0:
        place[g] = at
        at += len(members[g])
        g = above[g]
    order = [0] * (n + 1)
    placed = bytearray(n + 1)
    order[0] = n
    placed[n] = 1
    for i in range(n + 1):
        j = order[i] - 1
        while j >= 0 and not placed[j]:
            g = group[j]
            order[place[g]] = j
            place[g] += 1
            placed[j] = 1
            j = smaller[j]
    return order[1:]


# --- anchors ---------------------------------------------------------------

def _power(n: int) -> np.uint64:
    return np.uint64(pow(_MULT, n, 1 << 64))


def _grams(h: np.ndarray, width: int) -> np.ndarray:
    """Rolling hash of each ``width`` neighbours, by doubling."""
    out, taken, part, size = None, 0, h, 1
    left = width
    while left:
        if left & 1:
            if out is None:
                out = part
            else:
                m = len(h) - taken - size + 1
                out = out[:m] * _power(size) + part[taken:taken + m]
            taken += size
        left >>= 1
        if left:
            m = len(part) - size
            part = part[:m] * _power(size) + part[size:size + m]
            size *= 2
    return out[:len(h) - width + 1]


def _slide(x: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) over each ``width`` neighbours, by doubling."""
    size, part = 1, x
    while 2 * size <= width:
        part = pick(part[:-size], part[size:])
        size *= 2
    m = len(x) - width + 1
    return pick(part[:m], part[width - size:width - size + m])


#: Bytes of text whose anchors are searched together.
CHUNK = 1 << 17
Anchors = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def anchors(texts: list[bytes]) -> list[Anchors]:
    """For each text the positions and grams of its anchors, and the first and
    last window start of each.

    Of equal smallest grams in a window, the first is the anchor.  Texts are
    searched many at a time; windows across two of them are left out."""
    out: list[Anchors] = []
    k = 0
    while k < len(texts):
        size, j = 0, k
        while j < len(texts) and (j == k or size + len(texts[j]) <= CHUNK):
            size += len(texts[j])
            j += 1
        out += _anchors(texts[k:j])
        k = j
    return out


def _anchors(texts: list[bytes]) -> list[Anchors]:
    b = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum([len(t) for t in texts])
    none = np.zeros(0, np.int64)
    if len(b) < LENGTH:
        return [(none, np.zeros(0, np.uint64), none, none)] * len(texts)
    width = LENGTH - GRAM + 1
    grams = R.mixed(_grams(_BYTE[b], GRAM))
    low = _slide(grams, width, np.minimum)
    edge = np.zeros(width - 1, np.uint64)
    chosen = np.flatnonzero(_slide(np.concatenate([edge, low, edge]), width, np.maximum) == grams)
    inside = np.zeros(len(low), bool)
    for start, end in zip(ends - [len(t) for t in texts], ends):
        inside[start:max(end - LENGTH + 1, start)] = True
    starts = np.flatnonzero(inside)
    low = low[starts]
    # the anchor of a window is its first chosen gram that equals the window's least
    k = np.searchsorted(chosen, starts)
    wrong = np.flatnonzero(grams[chosen[k]] != low)
    while len(wrong):
        k[wrong] += 1
        wrong = wrong[grams[chosen[k[wrong]]] != low[wrong]]
    heads = np.flatnonzero(np.diff(k, prepend=-1))
    at = chosen[k[heads]]
    first, last = (starts[heads], starts[np.r_[heads[1:], len(k)] - 1]) if len(k) else (none, none)
    bounds = np.searchsorted(at, np.r_[0, ends])
    return [(at[x:y] - base, grams[at[x:y]], first[x:y] - base, last[x:y] - base)
            for x, y, base in zip(bounds, bounds[1:], np.r_[0, ends])]


def anchor_grams(texts: list[str]) -> list[np.ndarray]:
    return [np.unique(grams) for _, grams, _, _ in anchors([(t or "").encode() for t in texts])]


# --- pieces ----------------------------------------------------------------

#: Columns of packed pieces, after the row's kind and key.
PIECE, RANGE, TEXT = 3, 4, 5
SENT = np.dtype([("gram", "<u8"), ("doc", "<i8"), ("start", "<u4"), ("back", "u1"), ("size", "u1")])
#: Bytes by which grams travel to the buckets and back; a gram more is only work.
WIDTH, BACK = 6, 4


def _texts(parts: int):
    """Texts packed and compressed by document part."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(1).compress
        for docs, texts, rest in R.batches_of(batches):
            part = R.part_of(docs, parts)
            rows = []
            for p in np.unique(part):
                own = np.flatnonzero(part == p)
                data = [(x or "").encode() for i in own for x in (texts[i], rest[i])]
                rows.append(R.row(TEXT, p, docs[own].tobytes(), pack(b"".join(data)),
                                  np.array([len(d) for d in data], np.int64).tobytes()))
            yield R.record(rows)
        tidy()
    return run


def _unpacked(rows: pd.DataFrame) -> list[tuple[int, bytes, bytes]]:
    """Ids, texts and what else their rows hold, in one order whatever order the rows come in."""
    out = []
    unpack = zstandard.ZstdDecompressor().decompress
    for r in rows[rows["kind"] == TEXT].itertuples():
        whole, at = unpack(r.tokens), 0
        for d, (n, m) in zip(np.frombuffer(r.docs, np.int64).tolist(), np.frombuffer(r.numbers, np.int64).reshape(-1, 2).tolist()):
            out.append((d, whole[at:at + n], whole[at + n:at + n + m]))
            at += n + m
    return sorted(out)


def _placed(rows: list[tuple[int, bytes, bytes]]) -> Iterator[tuple[int, int, bytes, bytes]]:
    """Rows after the place where their text begins when the distinct texts of a document lie one after the other."""
    at, doc, text = 0, None, b""
    for d, data, rest in rows:
        if d != doc:
            at = 0
        elif data != text:
            at += len(text)
        doc, text = d, data
        yield at, d, data, rest


def _hash(data: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little")


def _pieces(heavy, buckets: int):
    """Pieces of a part for the buckets, and the ranges that repeat within the part."""
    def run(key, texts: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        part = int(key[0])
        known = heavy.value[0]
        pack = zstandard.ZstdCompressor(1).compress
        shared: dict[int, list[np.ndarray]] = {}
        if len(found):
            who = np.concatenate([np.frombuffer(b, np.int64) for b in found["docs"]])
            grams = np.concatenate([R.long(b, BACK) for b in found["tokens"]])
            order = np.argsort(who, kind="stable")
            who, grams = who[order], grams[order]
            heads = np.flatnonzero(np.r_[True, who[1:] != who[:-1]])
            shared = {int(who[h]): grams[h:e] for h, e in zip(heads, np.r_[heads[1:], len(who)])}
        nothing = np.zeros(0, np.uint64)
        owner: dict[tuple[int, bytes], int] = {}
        sent: dict[int, list[tuple]] = {}
        ranges: list[tuple[int, int, int]] = []

        def offer(gram: int, back: int, piece: bytes, doc: int, start: int) -> None:
            """A piece of windows, ``back`` bytes before its gram; documents come in order of their ids.
            ``start`` counts from the begin of the document's first text."""
            if owner.setdefault((gram, back, piece), doc) < doc:
                ranges.append((doc, start, start + len(piece)))
            else:
                sent.setdefault(gram % buckets, []).append((gram, back, piece, doc, start))

        rows_of = _unpacked(texts)
        for (base, doc, data, _), (at, grams, first, last) in zip(_placed(rows_of), anchors([r[1] for r in rows_of])):
            hot, _ = R.is_heavy(grams, known)
            use = hot | np.isin(grams & np.uint64((1 << 8 * BACK) - 1), shared.get(doc, nothing))
            use = np.flatnonzero(use)
            for p, s, e, gram, is_hot in zip(at[use].tolist(), first[use].tolist(), last[use].tolist(), grams[use].tolist(),
                                             hot[use].tolist()):
                if is_hot:
                    for w in range(s, e + 1):
                        piece = data[w:w + LENGTH]
                        offer(_hash(piece), 0, piece, doc, base + w)
                else:
                    offer(gram, p - s, data[s:e + LENGTH], doc, base + s)
        rows = []
        for b, own in sent.items():
            own.sort(key=itemgetter(2))  # pieces that begin alike lie together
            table = np.empty(len(own), SENT)
            for c, i in (("gram", 0), ("back", 1), ("doc", 3), ("start", 4)):
                table[c] = [o[i] for o in own]
            table["size"] = [len(o[2]) for o in own]
            rows.append((b, R.row(PIECE, part, b"", pack(b"".join(o[2] for o in own)), table.tobytes())))
        if ranges:
            rows.append((part % buckets, R.row(RANGE, part, np.array(ranges, np.int64).tobytes())))
        out = R.frame([r for _, r in rows])
        out.insert(0, "bucket", np.array([b for b, _ in rows], np.int32))
        rows.clear()
        tidy()
        return out
    return run


def equal_windows(strings: list[bytes]) -> np.ndarray:
    """For each window start of each string, one after the other, the number of its class of equal windows."""
    text = b"\0".join(strings)
    lengths = np.array([len(x) for x in strings], np.int64)
    starts = _ranges(np.cumsum(lengths + 1) - lengths - 1, lengths - LENGTH + 1)
    inside = np.zeros(len(text) + 1, bool)
    inside[starts] = True
    order = np.array(suffix_array(text), np.int64)
    order = order[inside[order]]
    b = np.frombuffer(text, np.uint8)
    new = np.ones(len(order), bool)
    for k in range(0, len(order), 1 << 16):  # neighbours in the suffix array that share LENGTH bytes
        own = b[order[k:k + (1 << 16) + 1, None] + np.arange(LENGTH)]
        new[k + 1:k + len(own)] = (own[1:] != own[:-1]).any(1)
    number = np.empty(len(text) + 1, np.int64)
    number[order] = np.cumsum(new) - 1
    return number[starts]


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers from each start on, ``lengths`` many, one range after the other."""
    before = np.cumsum(lengths) - lengths
    return np.arange(int(lengths.sum())) + np.repeat(starts - before, lengths)


def _runs(mask: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Owner, first place and place after the last of each run of true places, of owners that lie one after the other."""
    owner = np.repeat(np.arange(len(lengths)), lengths)
    opens = np.diff(owner, prepend=-1) != 0
    heads = np.flatnonzero(mask & (opens | ~np.r_[False, mask[:-1]]))
    tails = np.flatnonzero(mask & (np.r_[opens[1:], True] | ~np.r_[mask[1:], False]))
    base = np.cumsum(lengths) - lengths
    return owner[heads], heads - base[owner[heads]], tails + 1 - base[owner[heads]]


def _repeated_windows(grams: np.ndarray, back: np.ndarray, pieces: list[bytes]) -> np.ndarray:
    """Whether some other piece of its gram may hold a window, by hash (one that occurs once stands for a
    window that occurs once), for each window of each distinct piece, one piece after the other."""
    parts = []
    for k in range(0, len(pieces), 1 << 13):
        own = pieces[k:k + (1 << 13)]
        lengths = np.array([len(p) for p in own], np.int64)
        flat = np.frombuffer(b"".join(own), np.uint8)
        base = np.cumsum(lengths) - lengths
        hashes = np.zeros((len(own), BEFORE + AFTER + 1), np.uint64)
        byte = np.zeros((len(own), BEFORE + AFTER), np.uint64)  # bytes from each piece's own start on
        there = np.arange(BEFORE + AFTER)[None, :] < lengths[:, None]
        byte[there] = _BYTE[flat[_ranges(base, lengths)]]
        for j in range(BEFORE + AFTER):
            hashes[:, j + 1] = hashes[:, j] * np.uint64(_MULT) + byte[:, j]
        most = BEFORE + 1
        window = hashes[:, LENGTH:LENGTH + most] - hashes[:, :most] * _power(LENGTH)
        place = np.arange(most)[None, :] - back[k:k + len(own), None] + BEFORE  # in line with the gram's start
        window = R.mixed(window + grams[k:k + len(own), None] * _BYTE[np.clip(place, 0, 255)])
        parts.append(window[np.arange(most)[None, :] <= lengths[:, None] - LENGTH])
    keys = np.concatenate(parts)
    order = np.argsort(keys)
    new = np.flatnonzero(np.r_[True, keys[order][1:] != keys[order][:-1]])
    counts = np.diff(np.r_[new, len(keys)])
    several = np.zeros(len(keys), bool)
    several[order] = np.repeat(counts > 1, counts)
    return several


def repeated_ranges(grams: np.ndarray, back: np.ndarray, pieces: list[bytes], docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Piece, start and end of what to remove from each piece: windows that a smaller document holds."""
    number: dict[tuple[int, int, bytes], int] = {}
    which = np.array([number.setdefault(k, len(number)) for k in zip(grams.tolist(), back.tolist(), pieces)], np.int64)
    keys = list(number)
    windows = np.array([len(k[2]) for k in keys], np.int64) - LENGTH + 1
    base = np.cumsum(windows) - windows
    least = np.full(len(keys), np.iinfo(np.int64).max)
    np.minimum.at(least, which, docs)
    smallest = np.repeat(least, windows)  # document of each window of each distinct piece, at first the piece's own
    own = np.array([k[0] for k in keys], np.uint64)
    _, group, size = np.unique(own, return_inverse=True, return_counts=True)
    several = np.flatnonzero(size[group] > 1)
    if len(several):
        marks = _repeated_windows(own[several], np.array([keys[k][1] for k in several], np.int64), [keys[k][2] for k in several])
        at, first, end = _runs(marks, windows[several])
        at = several[at]
        strings: dict[bytes, int] = {}
        text = np.array([strings.setdefault(keys[k][2][a:e - 1 + LENGTH], len(strings))
                         for k, a, e in zip(at.tolist(), first.tolist(), end.tolist())], np.int64)
        if strings:
            classes = equal_windows(list(strings))
            sizes = np.array([len(x) for x in strings], np.int64) - LENGTH + 1
            its = classes[_ranges((np.cumsum(sizes) - sizes)[text], end - first)]
            places = _ranges(base[at] + first, end - first)
            best = np.full(int(classes.max()) + 1, np.iinfo(np.int64).max)
            np.minimum.at(best, its, smallest[places])
            smallest[places] = best[its]
    gone = smallest[_ranges(base[which], windows[which])] < np.repeat(docs, windows[which])
    piece, first, end = _runs(gone, windows[which])
    return piece, first, end - 1 + LENGTH


def _resolved(rows: pd.DataFrame) -> pd.DataFrame:
    """Ranges to remove, by document part, from the pieces of a bucket."""
    out = [R.row(*r) for r in rows.loc[rows["kind"] == RANGE, R._NAMES].itertuples(index=False)]
    sent = rows[rows["kind"] == PIECE]
    if len(sent):
        tables, parts, pieces = [], [], []
        unpack = zstandard.ZstdDecompressor().decompress
        for r in sent.itertuples():
            t = np.frombuffer(r.numbers, SENT)
            whole, ends = unpack(r.tokens), np.cumsum(t["size"], dtype=np.int64)
            pieces += [whole[e - n:e] for e, n in zip(ends.tolist(), t["size"].tolist())]
            tables.append(t)
            parts.append(np.full(len(t), r.key))
        t, parts = np.concatenate(tables), np.concatenate(parts)
        piece, first, end = repeated_ranges(t["gram"], t["back"].astype(np.int64), pieces, t["doc"])
        start = t["start"].astype(np.int64)[piece]
        found = np.stack([t["doc"][piece], start + first, start + end], 1)
        for p in np.unique(parts[piece]):
            out.append(R.row(RANGE, p, np.ascontiguousarray(found[parts[piece] == p]).tobytes()))
        del pieces, piece, first, end, start, found
    tidy()
    return R.frame(out)


def spans(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping or touching ranges as maximal ones."""
    out: list[list[int]] = []
    for a, e in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([a, e])
    return [(a, e) for a, e in out]


def _removed(texts: pd.DataFrame, found: pd.DataFrame, characters: bool) -> pd.DataFrame:
    gone: dict[int, list[tuple[int, int]]] = {}
    for b in found["docs"] if len(found) else ():
        for d, a, e in np.frombuffer(b, np.int64).reshape(-1, 3).tolist():
            gone.setdefault(d, []).append((a, e))
    for own in gone.values():
        own.sort()
    out = []
    for base, doc, data, rest in _placed(_unpacked(texts)):
        own = gone.get(doc, [])
        low, high = bisect_left(own, (base,)), bisect_left(own, (base + len(data),))
        cut = spans([(a - base, e - base) for a, e in own[low:high]])
        kept, at = [], 0
        for a, e in cut:
            kept.append(data[at:a])
            at = e
        kept.append(data[at:])
        if characters:  # a run begins or ends inside a character only where a cut went through it
            kept = [k.decode(errors="ignore").encode() for k in kept]
        out.append((doc, len(data), sum(e - a for a, e in cut), len(cut), b"".join(kept), rest.decode()))
    return pd.DataFrame(out, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "rest"])


def dedup_bytes(docs: DataFrame, rest: Column | None = None, characters: bool = False) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` (the remaining bytes) of every row, and ``rest``: a
    string of each row that comes along.  With ``characters`` a character of which a byte went is not kept."""
    spark = docs.sparkSession
    python_ready(spark)
    every = docs.select(F.col("doc_id").cast("long"), "text", (F.lit("") if rest is None else rest).alias("rest"))
    rows = every.filter("doc_id is not null")
    texts = rows.select("doc_id", "text")
    size = texts.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first()
    parts = max(1, -(-size["bytes"] // PART_BYTES))
    buckets = max(1, -(-size["bytes"] * 2 // (LENGTH - GRAM) // R.BUCKET_TOKENS), parts)
    heavy = R.heavy_tokens(texts, anchor_grams, size["rows"])
    shared = spark.sparkContext.broadcast(heavy)
    packed = texts.withColumn("rest", F.lit("")).mapInArrow(_texts(parts), R.SCHEMA)
    found = R.repeated(texts, anchor_grams, heavy, buckets, parts, width=WIDTH, back=BACK)
    pieces = packed.groupBy("key").cogroup(found.groupBy("key")).applyInPandas(_pieces(shared, buckets), "bucket int, " + R.SCHEMA)
    ranges = stored(pieces.groupBy("bucket").applyInPandas(_resolved, R.SCHEMA), "suffix-ranges")
    again = rows.mapInArrow(_texts(parts), R.SCHEMA)
    done = again.groupBy("key").cogroup(ranges.groupBy("key")).applyInPandas(
        lambda texts, found: _removed(texts, found, characters), "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, rest string")
    whole = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    none = F.lit(0).cast("long")
    loose = every.filter("doc_id is null").select("doc_id", F.octet_length(whole).cast("long").alias("n_bytes"), none.alias("n_removed"),
                                                  none.alias("n_spans"), whole.alias("kept"), "rest")
    return done.unionByName(loose)


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with ``text`` reduced to the bytes that stay; a character of which a byte went, goes."""
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    names = [f"c{i}" for i in range(len(others))]  # any names, even equal in other cases, come through
    rest = F.to_json(F.struct(*[docs[c].alias(n) for c, n in zip(others, names)])) if others else None
    kept = dedup_bytes(docs, rest, characters=True)
    shape = T.StructType([T.StructField(n, docs.schema[c].dataType) for c, n in zip(others, names)])
    kept = kept.withColumn("_rest", F.from_json("rest", shape)) if others else kept
    columns = {"doc_id": F.col("doc_id"), "text": F.expr("cast(kept as string)")}
    columns |= {c: F.col(f"_rest.{n}") for c, n in zip(others, names)}
    return kept.select(*[columns[c].alias(c) for c in docs.columns])
