"""Periodic run detection (operator 13): Baier grouping, Lyndon roots, LCE.

A run is a maximal stretch of words with smallest period q.  By the runs
theorem each run holds a Lyndon root: the longest Lyndon word from some
position, under an order of the words or under its reverse.  So:

1. ``lyndon_array`` is phase one of Baier's suffix sorter.  Positions are
   grouped by their word; groups are taken from the highest down.  Each
   member leaves a list of open positions, and the open position before it
   takes it in: it moves to a new group right above its own, by how many
   members it took.  A group's common length when its turn comes is the
   length of the longest Lyndon word at its members.  Nothing is sorted
   further, every position is touched once.
2. That is done under both orders.  Every (position, length) is a candidate
   root, and the longest common extensions to both sides tell its run.

Only parts of a text that can hold a run are looked at.  In a run of at
least 12 words, each word lies in a group of four words that occurs again in
the same run.  ``repeating`` keeps, for a whole Arrow batch at once, the
stretches that such groups cover, and repeats this within each stretch until
nothing changes; no run is lost by it.

Words are compared by 64-bit hashes, and the runs found are checked on the
words themselves; a text where that fails is done again by its words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from godown.llm.common import out_batch, slices
from godown.llm.words import mix, ngrams, word_hashes

#: Fewest words of a run, whatever its period; `repeating` relies on it being at least 2 * GRAM + 2.
LEAST = 12
GRAM = 4
RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


def lyndon_array(s: np.ndarray) -> np.ndarray:
    """Length of the longest Lyndon word from each position of ``s``."""
    n = len(s)
    if n == 0:
        return np.zeros(0, np.int64)
    by_word = np.argsort(s, kind="stable")
    first = np.flatnonzero(np.concatenate([[True], s[by_word][1:] != s[by_word][:-1]]))
    # positions count from 1; 0 and n + 1 end the list of open ones
    members = [m.tolist() for m in np.split(by_word + 1, first[1:])]
    group = [0] * (n + 2)
    for g, m in enumerate(members):
        for i in m:
            group[i] = g
    size = [1] * len(members)
    below, above = list(range(-1, len(members) - 1)), list(range(1, len(members) + 1))
    left, right, out = list(range(-1, n + 1)), list(range(1, n + 3)), [0] * (n + 1)
    g = len(members) - 1
    while g >= 0:
        length, takers, times = size[g], [], []
        last = 0
        for i in members[g]:
            if group[i] != g:                  # has moved up, and was done with its new group
                continue
            out[i] = length
            p, r = left[i], right[i]
            right[p], left[r] = r, p
            if p:
                if p == last:
                    times[-1] += 1
                else:
                    takers.append(p)
                    times.append(1)
                    last = p
        moved: dict[tuple[int, int], list[int]] = {}
        for p, c in zip(takers, times):
            moved.setdefault((group[p], c), []).append(p)
        under = {}
        for h, c in sorted(moved):
            new, low = len(members), under.get(h, h)
            members.append(moved[h, c])
            size.append(size[h] + c * length)
            for p in members[new]:
                group[p] = new
            up = above[low]
            below.append(low)
            above.append(up)
            above[low] = new
            if up < len(below) - 1:
                below[up] = new
            under[h] = new
        members[g] = []
        g = below[g]
    return np.array(out[1:], np.int64)


def runs_of(s: np.ndarray, least: int = LEAST) -> list[tuple[int, int, int]]:
    """(start, end, period) of every run of at least max(least, 2 * period) values, by start and period.

    Extensions are read off the mismatches at distance q, once per period of
    a candidate that agrees at three places in a row on one side; so the
    work is the length times the number of periods that come near a run.
    """
    n = len(s)
    s = np.unique(s, return_inverse=True)[1]
    found = set()
    near = (max(least, 2) + 3) // 4            # of R + L >= max(q, least - q) >= least / 2, one side has a half
    for order in (s, -s):
        q = lyndon_array(order)
        i = np.flatnonzero(2 * q <= n)
        q = q[i]
        i, q = i[i + q < n], q[i + q < n]
        fits = np.zeros(len(i), bool)
        for side in (range(near), range(-1, -near - 1, -1)):
            ok = np.ones(len(i), bool)
            for k in side:
                a, b = i + k, i + q + k
                ok &= (a >= 0) & (b < n)
                ok &= s[np.clip(a, 0, n - 1)] == s[np.clip(b, 0, n - 1)]
            fits |= ok
        i, q = i[fits], q[fits]
        for period in np.unique(q).tolist():
            at = i[q == period]
            breaks = np.concatenate([[-1], np.flatnonzero(s[:-period] != s[period:]), [n - period]])
            # matches at distance `period` hold between two breaks; a root may lie across one
            k = np.searchsorted(breaks, at)
            end = breaks[k] + period
            k = np.searchsorted(breaks, at, side="left")
            start = breaks[k - 1] + 1
            ok = end - start >= max(least, 2 * period)
            found.update(zip(start[ok].tolist(), end[ok].tolist(), [period] * int(ok.sum())))
    return sorted((a, b, p) for a, b, p in found)


def repeating(h: np.ndarray, cuts: np.ndarray) -> list[tuple[int, int, int]]:
    """(row, first, end) of the stretches of words that may hold runs; ``cuts`` as from ``word_hashes``."""
    at = np.arange(len(h))
    part = np.repeat(np.arange(len(cuts) - 1), np.diff(cuts))
    row = part
    while len(at):
        m = max(0, len(at) - GRAM + 1)
        whole = part[:m] == part[len(at) - m:]
        key = mix(ngrams(h[at], GRAM) + mix(part[:m].astype(np.uint64)))
        key, place = key[whole], np.flatnonzero(whole)
        order = np.argsort(key)
        twin = key[order][1:] == key[order][:-1]
        again = np.zeros(len(key), bool)
        again[order[1:][twin]] = True
        again[order[:-1][twin]] = True
        cover = np.zeros(len(at), bool)
        for k in range(GRAM):
            cover[place[again] + k] = True
        new = cover & np.concatenate([[True], ~cover[:-1] | (part[1:] != part[:-1])])
        number = np.cumsum(new)[cover] - 1
        long = np.bincount(number, minlength=int(new.sum())) >= LEAST
        keep = np.flatnonzero(cover)[long[number]]
        number = number[long[number]]
        if len(keep) == len(at):
            break
        at, row, part = at[keep], row[keep], number
    if not len(at):
        return []
    first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
    last = np.concatenate([first[1:], [len(at)]]) - 1
    return list(zip(row[first].tolist(), at[first].tolist(), (at[last] + 1).tolist()))


def collapse(words: list[bytes], runs) -> bytes:
    """The words joined by a space, without what each run repeats after its first period."""
    gone = np.zeros(len(words) + 1, np.int64)
    for a, b, p in runs:
        gone[a + p] += 1
        gone[b] -= 1
    kept = np.flatnonzero(np.cumsum(gone[:-1]) == 0).tolist()
    return b" ".join([words[k] for k in kept])


def text_runs(batches, text_col: str):
    for part in slices(batches, text_col):
        col = part.column(part.schema.get_field_index(text_col))
        h, cuts = word_hashes(col)
        found: dict[int, list] = {}
        for row, a, b in repeating(h, cuts):
            off = a - int(cuts[row])
            found.setdefault(row, []).extend((x + off, y + off, p) for x, y, p in runs_of(h[a:b]))
        runs, texts = [], []
        raw = col.fill_null("").cast(pa.large_binary())
        for k in range(part.num_rows):
            words = raw[k].as_py().split()
            mine = found.get(k) or []
            if any(words[a:b - p] != words[a + p:b] for a, b, p in mine):     # different words of one hash
                rank = {w: i for i, w in enumerate(dict.fromkeys(words))}
                mine = runs_of(np.array([rank[w] for w in words]))
            runs.append([{"start": a, "length": b - a, "period": p} for a, b, p in mine])
            texts.append((collapse(words, mine) if mine else b" ".join(words)).decode())
        kinds = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        keep = [c for c in part.schema.names if c != text_col]
        yield out_batch([*keep, "n_words", "runs", "collapsed"],
                        [*(part.column(part.schema.get_field_index(c)) for c in keep),
                         pa.array(np.diff(cuts), pa.int64()), pa.array(runs, kinds), pa.array(texts, pa.string())])


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, runs (start, length, period by start, then period), collapsed: one row per row of ``docs``.

    Words are stretches without ASCII white space; ``collapsed`` joins those
    that no run repeats by one space.  A null or empty text has no words, no
    runs and an empty ``collapsed``.  Rows are worked on one by one, so
    repeated rows and ids (null ones too) give a row each.  Extra columns of
    ``docs`` are left out whatever their names.  An empty table gives none.
    """
    rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(lambda batches: text_runs(batches, "text"),
                           f"doc_id {kind}, n_words bigint, runs {RUNS}, collapsed string")


def longest(runs) -> F.Column:
    """The run with the greatest length (then smallest start, then period) of a column of runs; null if none."""
    order = F.transform(runs, lambda r: F.struct((-r["length"]).alias("a"), r["start"].alias("start"), r["period"].alias("period")))
    first = F.array_min(order)
    return F.when(first.isNotNull(), F.struct(first["start"].alias("start"), (-first["a"]).alias("length"), first["period"].alias("period")))
