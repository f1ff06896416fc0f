"""Spelling variants by finite-state composition: acceptor, one-edit transducer, acceptor."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dualscript.llm.common import LOWER, UPPER, stored

LETTERS = r"A-Za-zÀ-ÿ"  # fixed value: the letters of a word
LENGTH, COUNT, TIMES = 7, 2, 10  # of words that count; of a form's count over its variant's
LARGE = 20_000  # words of an initial state from which it is split at its edits
ROWS = 60_000  # words of one acceptor, about: the memory bound of a task
SALTS = 64

_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53))


def word_counts(docs: DataFrame, key: str, text: str, damage: int | None) -> DataFrame:
    """``word, n``: runs of letters, A-Z in lower case, that are long and frequent enough.

    With ``damage``, runs whose checksum with the key it divides lose one
    character first; a null key is an empty one there.
    """
    run = F.explode(F.regexp_extract_all(text, F.lit(f"[{LETTERS}]{{{LENGTH},}}"), F.lit(0)))
    runs = docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("_k"), run.alias("_run"))
    low = F.translate("_run", UPPER, LOWER)
    if damage is None:
        words = runs.select(low.alias("word"))
    else:
        h = F.crc32(F.concat("_k", F.lit(":"), low).cast("binary"))
        made = runs.select(low.alias("_low"), h.alias("_h"))
        at = F.pmod(F.col("_h"), F.length("_low")).cast("int")
        cut = F.concat(F.substring("_low", F.lit(1), at), F.substring("_low", at + 2, F.length("_low")))
        words = made.select(F.when(F.col("_h") % damage == 0, cut).otherwise(F.col("_low")).alias("word"))
        words = words.where(F.length("word") >= LENGTH)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= COUNT)


# ---------------------------------------------------------------- machines


def _hash(x: np.ndarray, k: int) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MIX[k]
    return (x ^ (x >> np.uint64(29))) * _MIX[k + 2]


def _spread(starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For ranges ``starts, sizes``: the range of each item, and the item's number."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    first = np.cumsum(sizes) - sizes
    return owner, np.arange(len(owner)) - np.repeat(first, sizes) + np.repeat(starts, sizes)


def _distinct(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of one row of each kind, and the kind of every row."""
    order = np.lexsort(columns[::-1])
    new = np.ones(len(order), bool)
    new[1:] = np.logical_or.reduce([c[order][1:] != c[order][:-1] for c in columns])
    kind = np.empty(len(order), np.int64)
    kind[order] = np.cumsum(new) - 1
    return order[new], kind


@dataclass
class Acceptor:
    """A minimised acceptor with an initial state per group.

    Words are rows of ``chars``, padded by 0, sorted by group and characters.
    ``tree_state`` and ``tree_row`` give the state and the first row of every
    prefix; a state's arcs lie from ``begin`` on and hold a character, the next
    state, and how many rows further down the words behind the arc begin.
    """

    final: np.ndarray
    begin: np.ndarray
    degree: np.ndarray
    char: np.ndarray
    to: np.ndarray
    skip: np.ndarray
    tree_state: np.ndarray
    tree_row: np.ndarray

    @classmethod
    def build(cls, group: np.ndarray, chars: np.ndarray) -> Acceptor:
        """Equal right languages, told by 128 bits of hash from the leaves up, are one state."""
        rows, width = chars.shape
        differs = np.ones((rows, width + 1), bool)
        differs[1:, 0] = group[1:] != group[:-1]
        differs[1:, 1:] = chars[1:] != chars[:-1]
        fresh = np.logical_or.accumulate(differs, axis=1)  # a new prefix of this length begins
        real = np.concatenate([np.ones((rows, 1), bool), chars != 0], axis=1)
        number = np.zeros((width + 1, rows), np.int64)
        starts, base = [], 0
        for d in range(width + 1):
            at = np.flatnonzero(fresh[:, d] & real[:, d])
            number[d] = base + np.searchsorted(at, np.arange(rows), side="right") - 1
            starts.append(at)
            base += len(at)
        size = np.ones(base, np.int64)
        one, two = np.zeros(base, np.uint64), np.zeros(base, np.uint64)
        final = np.zeros(base, bool)
        arcs = []
        for d in range(width, -1, -1):
            at = starts[d]
            nodes = number[d][at]
            final[nodes] = ~real[at, d + 1] if d < width else True
            if d < width:
                kids = starts[d + 1]
                up, down, c = number[d][kids], number[d + 1][kids], chars[kids, d]
                for h, k in ((one, 0), (two, 1)):
                    np.add.at(h, up, _hash(_hash(h[down], k) + c.astype(np.uint64), k))
                arcs.append((up, c, down, kids))
            one[nodes] = _hash(one[nodes] + final[nodes].astype(np.uint64) + np.uint64(1), 0)
            two[nodes] = _hash(two[nodes] + final[nodes].astype(np.uint64) + np.uint64(1), 1)
        row = np.concatenate(starts)
        sample, state = _distinct(one, two)
        up, c, down, kids = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in zip(*arcs)) if arcs else [np.zeros(0, np.int64)] * 4
        kept = sample[state[up]] == up  # the arcs of one prefix per state
        up, c, down, kids = up[kept], c[kept], down[kept], kids[kept]
        order = np.lexsort((c, state[up]))
        up, c, down, kids = up[order], c[order], down[order], kids[order]
        degree = np.bincount(state[up], minlength=len(sample))
        return cls(final[sample], np.cumsum(degree) - degree, degree, c.astype(np.int64), state[down],
                   kids - row[up], state, row)


@dataclass
class Pairs:
    """Items that read two words at once: both states, and both words' first rows."""

    owner: np.ndarray  # the item they come from
    left: np.ndarray
    right: np.ndarray
    left_skip: np.ndarray
    right_skip: np.ndarray


def _edits(a: Acceptor, states: np.ndarray) -> Pairs:
    """What the transducer's edit makes of each state read twice: two unlike characters, or one on the right alone."""
    owner, arc = _spread(a.begin[states], a.degree[states])
    alone = Pairs(owner, states[owner], a.to[arc], np.zeros(len(arc), np.int64), a.skip[arc])
    later = a.begin[states][owner] + a.degree[states][owner] - arc - 1  # arcs of greater characters
    first, other = _spread(arc + 1, later)
    return Pairs(*[np.concatenate([x, y]) for x, y in zip(
        (owner[first], a.to[arc[first]], a.to[other], a.skip[arc[first]], a.skip[other]),
        (alone.owner, alone.left, alone.right, alone.left_skip, alone.right_skip))])


def _equal(a: Acceptor, left: np.ndarray, right: np.ndarray) -> Pairs:
    """Both words read one equal character."""
    small = np.where(a.degree[left] <= a.degree[right], left, right)
    owner, arc = _spread(a.begin[small], a.degree[small])
    turned = (small != left)[owner]
    other = np.where(turned, left[owner], right[owner])
    key = a.char.max(initial=0) + 1
    keys = np.repeat(np.arange(len(a.degree)), a.degree) * key + a.char
    wanted = other * key + a.char[arc]
    at = np.minimum(np.searchsorted(keys, wanted), max(len(keys) - 1, 0))
    hit = keys[at] == wanted if len(keys) else np.zeros(0, bool)
    owner, arc, at, turned = owner[hit], arc[hit], at[hit], turned[hit]
    l, r = np.where(turned, at, arc), np.where(turned, arc, at)
    return Pairs(owner, a.to[l], a.to[r], a.skip[l], a.skip[r])


def near_rows(group: np.ndarray, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of words of one group that are one edit apart; of unlike lengths the shorter one first.

    The composed machine is built on pairs of states after the edit, trimmed
    to those from which both words can end together; then the accepted pairs
    are read off along the prefixes of each group, an edit at a time.
    """
    a = Acceptor.build(group, chars)
    found = _edits(a, np.arange(len(a.degree)))
    first, kind = _distinct(found.left, found.right)
    left, right = found.left[first], found.right[first]
    source, target = [], []
    known, fresh = np.stack([left, right]), np.arange(len(left))
    while len(fresh):  # the machine's states after the edit
        step = _equal(a, known[0][fresh], known[1][fresh])
        both = np.concatenate([known, np.stack([step.left, step.right])], axis=1)
        place, number = _distinct(both[0], both[1])
        # old states keep their numbers, new ones follow
        rename = np.full(len(place), -1)
        rename[number[:known.shape[1]]] = np.arange(known.shape[1])
        new = np.flatnonzero(rename < 0)
        rename[new] = known.shape[1] + np.arange(len(new))
        source.append(fresh[step.owner])
        target.append(rename[number[known.shape[1]:]])
        known, fresh = np.concatenate([known, both[:, place[new]]], axis=1), known.shape[1] + np.arange(len(new))
    source, target = np.concatenate(source or [[]]).astype(np.int64), np.concatenate(target or [[]]).astype(np.int64)
    live = a.final[known[0]] & a.final[known[1]]
    while True:
        add = live[target] & ~live[source]
        if not add.any():
            break
        live[source[add]] = True
    useful = live[kind]
    found = Pairs(found.owner[useful], found.left[useful], found.right[useful], found.left_skip[useful], found.right_skip[useful])
    count = np.bincount(found.owner, minlength=len(a.degree))
    order = np.argsort(found.owner, kind="stable")
    begin = np.cumsum(count) - count
    item, at = _spread(begin[a.tree_state], count[a.tree_state])
    at = order[at]
    p, r = found.left[at], found.right[at]
    i, j = a.tree_row[item] + found.left_skip[at], a.tree_row[item] + found.right_skip[at]
    out_i, out_j = [], []
    good = known[0] * (len(a.degree) + 1) + known[1]
    good = np.sort(good[live])
    while len(p):
        ends = a.final[p] & a.final[r]
        out_i.append(i[ends])
        out_j.append(j[ends])
        step = _equal(a, p, r)
        i, j = i[step.owner] + step.left_skip, j[step.owner] + step.right_skip
        p, r = step.left, step.right
        key = p * (len(a.degree) + 1) + r
        at = np.minimum(np.searchsorted(good, key), max(len(good) - 1, 0))
        stay = good[at] == key if len(good) else np.zeros(0, bool)
        p, r, i, j = p[stay], r[stay], i[stay], j[stay]
    none = np.zeros(0, np.int64)
    # an insertion among equal characters has several places
    both = np.unique(np.concatenate([none, *out_i]) * len(chars) + np.concatenate([none, *out_j]))
    return both // max(len(chars), 1), both % max(len(chars), 1)


# ---------------------------------------------------------------- partitions


_NEAR = pa.schema([("word", pa.string()), ("_near", pa.int64()), ("_n", pa.int64()), ("_form", pa.string())])


def _matrix(tails: list[str]) -> np.ndarray:
    """Code points, a row per word, padded by 0."""
    sizes = np.fromiter(map(len, tails), np.int64, len(tails))
    out = np.zeros((len(tails), int(sizes.max(initial=0))), np.uint32)
    out[np.arange(out.shape[1])[None, :] < sizes[:, None]] = np.frombuffer("".join(tails).encode("utf-32-le"), "<u4")
    return out


def _best(words: list[str], counts: np.ndarray, heads: list, tails: list[str], sizes: np.ndarray, long: np.ndarray) -> list[tuple]:
    """Per word with near words in its group: how many, and the one of largest count, of these the least."""
    place = {h: k for k, h in enumerate(dict.fromkeys(heads))}
    group = np.fromiter((place[h] for h in heads), np.int64, len(heads))
    tally: dict[int, list] = {}
    chars = _matrix(tails)
    order = np.lexsort((*chars.T[::-1], group))
    i, j = near_rows(group[order], chars[order])
    i, j = order[i], order[j]
    # pairs of two longer words belong to the groups of their own length
    keep = ~(long[i] & long[j])
    i, j = i[keep], j[keep]
    # an insertion behind all that the suffix leaves is found in the group of the prefix
    ends = np.array([h[0] for h in heads])[i] == "S"
    apart = np.flatnonzero(ends & (sizes[i] != sizes[j]))
    drop = np.zeros(len(i), bool)
    drop[apart] = [tails[y].startswith(tails[x]) for x, y in zip(i[apart].tolist(), j[apart].tolist())]
    i, j = i[~drop], j[~drop]
    own, near = np.concatenate([i, j]), np.concatenate([j, i])
    if not len(own):
        return []
    rank = np.empty(len(words), np.int64)
    rank[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
    order = np.lexsort((rank[near], -counts[near], own))
    own, near = own[order], near[order]
    first = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
    many = np.diff(np.append(first, len(own)))
    return [(words[a], int(m), int(counts[b]), words[b]) for a, b, m in zip(own[first].tolist(), near[first].tolist(), many.tolist())]


def _compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near words inside the groups of a sorted partition; groups are whole, and small ones share an acceptor."""
    held: list[tuple] = []

    def done(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        by_class: dict[int, list[tuple]] = {}
        for row in rows:
            by_class.setdefault(row[1], []).append(row)  # words of like length: a matrix without much padding
        for members in by_class.values():
            side, size, head, word, n, tail = map(list, zip(*members))
            sizes = np.fromiter(map(len, word), np.int64, len(word))
            out = _best(word, np.array(n, np.int64), list(zip(side, head)), tail, sizes, sizes > np.array(size))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _NEAR)], schema=_NEAR)

    for batch in batches:
        held += zip(*[c.to_pylist() for c in batch.columns])
        if len(held) >= ROWS:
            last = held[-1][:3]
            k = len(held)
            while k and held[k - 1][:3] == last:
                k -= 1
            yield from done(held[:k])
            held = held[k:]
    yield from done(held)


def _groups(words: DataFrame) -> DataFrame:
    """``_side, _size, _head, word, n, _tail``: each word in the groups of its halves, as one of its length and as a longer partner.

    Two words of lengths L and L or L + 1 that are one edit apart share the
    first half of L characters or all characters behind it.
    """
    size = F.length("word")

    def state(side: str, shorter: int) -> Column:
        length = size - shorter
        half = F.floor(length / 2).cast("int")
        rest = length - half
        head, tail = ((F.substring("word", F.lit(1), half), F.substring("word", half + 1, size)) if side == "P" else
                      (F.substring("word", size - rest + 1, rest), F.substring("word", F.lit(1), size - rest)))
        return F.struct(F.lit(side).alias("_side"), length.alias("_size"), head.alias("_head"), tail.alias("_tail"))

    states = F.array(*[state(side, shorter) for side in "PS" for shorter in (0, 1)])
    return words.select("word", "n", F.explode(states).alias("_s")).select("_s._side", "_s._size", "_s._head", "word", "n", "_s._tail")


def _split(large: DataFrame) -> DataFrame:
    """Near words of large groups: one state per place of the edit, which holds a word per character at most.

    A state is what stands before and behind the edit.  Words that differ in a
    character there are near; so is the one that has none, if the edit is the
    last of the equal ones.
    """
    tail, size = F.col("_tail"), F.length("_tail")
    long = F.length("word") > F.col("_size")
    at = large.select(*large.columns, long.alias("_long"), F.explode(F.sequence(F.lit(0), size)).alias("_at"))
    front, back = F.substring(tail, F.lit(1), F.col("_at")), F.substring(tail, F.col("_at") + 1, size)
    with_, without = (F.struct(front.alias("front"), F.substring(back, F.lit(2), size).alias("back"), F.substring(back, 1, 1).alias("c")),
                      F.struct(front.alias("front"), back.alias("back"), F.lit("").alias("c")))
    edits = at.select("_side", "_size", "_head", "word", "n", "_long", F.explode(
        F.when(F.col("_at") < size, F.array(with_, without)).otherwise(F.array(without))).alias("_e"))
    # only shorter words lack a character, and only where they can have a longer partner
    edits = edits.where("_e.c <> '' or not _long")
    members = edits.groupBy("_side", "_size", "_head", "_e.front", "_e.back").agg(
        F.collect_list(F.struct("word", "n", F.col("_e.c").alias("c"), "_long")).alias("_m")).where(F.size("_m") > 1)

    def linked(x: Column, y: Column) -> Column:
        after = F.substring("back", 1, 1)
        missing = (x["c"] == "") | (y["c"] == "")
        c = F.concat(x["c"], y["c"])
        whole = (x["_long"] != y["_long"]) & (c != after)
        # an insertion at the end of what the suffix leaves is found at the prefix
        whole = whole & ~((F.col("_side") == "S") & (F.col("back") == ""))
        return F.when(missing, whole).otherwise((x["c"] != y["c"]) & ~(x["_long"] & y["_long"]))

    def order(y: Column) -> Column:
        return F.struct((-y["n"]).alias("n"), y["word"].alias("word"))

    pairs = F.transform("_m", lambda x: F.struct(x["word"].alias("word"), F.filter("_m", lambda y: linked(x, y)).alias("near")))
    each = members.select(F.explode(pairs).alias("p")).where(F.size("p.near") > 0)
    best = F.array_min(F.transform("p.near", order))
    return each.select("p.word", F.size("p.near").cast("long").alias("_near"), (-best["n"]).alias("_n"), best["word"].alias("_form"))


def near_words(words: DataFrame) -> DataFrame:
    """``word, n_near, _best``: how many words of ``words (word, n)`` are one edit away, and the count and name of the largest.

    Words meet in groups that share half of their characters, the initial
    states; a task composes the acceptor of some groups with the edit and
    itself.  Groups above ``LARGE`` words are split at the edit, so that none
    is gathered in one task.
    """
    groups = stored(_groups(words), "spelling-states")
    keys = ["_side", "_size", "_head"]
    large = groups.groupBy(*keys).agg(F.count("*").alias("_many")).where(F.col("_many") > LARGE).drop("_many")
    large = stored(large, "spelling-large")  # at most 4 / LARGE of the words
    small = groups.join(large, keys, "left_anti").select(*keys, "word", "n", "_tail")
    small = small.repartition(*[F.col(k) for k in keys]).sortWithinPartitions(*keys)
    found = small.mapInArrow(_compose, "word string, _near long, _n long, _form string")
    if not large.isEmpty():
        found = found.unionByName(_split(groups.join(large, keys)))
    order = F.struct((-F.col("_n")).alias("n"), F.col("_form").alias("word"))
    return found.groupBy("word").agg(F.sum("_near").alias("n_near"), F.min(order).alias("_best"))


def variants(words: DataFrame) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` for every row of ``words (word, n)``, distinct words with their counts.

    A word's form is its near word of largest count, of these the least in
    code-point order, if that count is ``TIMES`` its own or more.  Roots follow
    forms to the last; counts rise ``TIMES`` fold with each step, so there are
    few.  An empty table gives an empty result; null words are left out.
    """
    words = stored(words.where("word is not null").select("word", F.col("n").cast("long").alias("n")), "spelling-words")
    near = words.join(near_words(words), "word", "left")
    enough = -F.col("_best.n") >= TIMES * F.col("n")
    table = stored(near.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, F.col("_best.word")).alias("form"), F.when(enough, -F.col("_best.n")).cast("long").alias("form_n")),
        "spelling-forms")
    step = table.where("form is not null").select("word", F.col("form").alias("root"))
    while True:
        # each round doubles the steps that a root stands for
        ahead = step.select(F.col("word").alias("_at"), F.col("root").alias("_ahead"))
        on = step.join(ahead, F.col("root") == F.col("_at"), "left")
        more = stored(on.select("word", F.coalesce("_ahead", "root").alias("root"), F.col("_ahead").isNotNull().alias("_moved")), "spelling-roots")
        step = more.drop("_moved")
        if more.where("_moved").isEmpty():
            break
    return table.join(step, "word", "left").withColumn("root", F.coalesce("root", "word"))


def spelling_variants(docs: DataFrame, key: str = "doc_id", text: str = "text", damage: int | None = None) -> DataFrame:
    """``variants`` of the words of all texts.

    Words are maximal runs of letters, A-Z in lower case, of ``LENGTH`` code
    points or more that occur ``COUNT`` times or more; null texts have none.
    Repeated rows count one by one.
    """
    return variants(word_counts(docs, key, text, damage))
