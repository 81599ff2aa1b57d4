"""Near-duplicates by ProbMinHash signatures, banding and exact verification.

Texts are bags of ``SHINGLE``-word shingles, weighted by how often they occur; a text of fewer
words is one shingle. Each shingle sends arrivals of a Poisson process whose rate is its weight,
each to a random register; a register keeps its earliest shingle. A shingle stops as soon as its
next arrival comes later than all registers hold. Two texts agree in a register with the
probability Jaccard similarity. Texts that agree in all registers of a band are candidates;
those whose exact similarity is ``THRESHOLD`` or more are linked, and classes are what links
connect.

Equal texts are one before banding. Each bucket of a band has a centre, the text with the
least of its own, and each text is held against the best centre of its buckets first, then
against a few centres of each bucket that still holds several classes. What a text shares with no
other candidate bounds its similarity to any of them; texts that this keeps below the threshold
leave the bucket first. So a large group of near copies costs a few comparisons each.

What is left is compared by prefixes: each text's rarest shingles, those of a fifth of its weight
and one more. Texts whose prefixes have nothing in common can't be linked, and what two prefixes
have in common bounds what their texts lack of each other. Buckets that common texts connect are
taken as one if that has fewer pairs. A large bucket is dealt into blocks; a task holds two blocks
against each other by prefix and compares the pairs that the bound allows by all of their shingles,
unless links it has found connect them already. So no class is lost, and a task hands on fewer links
than it holds texts. The work of comparing grows with the square of a bucket's texts that are left,
divided over the pairs of blocks; a task's rows and memory do not.

Between signatures and classes, a text goes by a number that it has from a stored table: numbers are
half as long as keys and shuffle for less.

NULL texts and texts without words are linked to none. Rows of equal id and text are in one
class; ``first_of_each`` keeps one of them. NULL ids come last when the representative of a
class is chosen. An empty table gives an empty result. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugemill.llm.components import connected_components
from gaugemill.llm.words import Words, mix, slices, windows_of, words_of

SHINGLE = 5
THRESHOLD = 0.8
EXACT = Fraction(4, 5)  # the threshold, where floats are too coarse
SLACK = 1e-9  # more than floats are off by
BANDS = 32
ROWS = 4  # registers of a band
CENTRES = 4  # of each bucket, in the second round of comparisons
FEW = 8  # members of a bucket whose pairs are all compared as texts
BLOCK = 1024  # members of a block of a larger bucket, about
BLOCK_SHINGLES = 1 << 19  # of a block, about; one text's are not divided
WIDTH = 1024  # shingles that are compared at once

NewPath = Callable[[], str]

# What is known of a text as a member of a bucket.
_MEMBER = ("content", "size", "distinct", "own", "label", "buckets")

_STEP = np.uint64(0x9E3779B97F4A7C15)
_OTHER = np.uint64(0xD6E8FEB86659FD93)


# Signatures


def shingle_counts(words: Words, width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles: hash, text, and how often it occurs there."""
    hashes, text = windows_of(words, width)
    keys = mix(hashes + text.astype(np.uint64) * _STEP)
    order = np.argsort(keys)
    keys = keys[order]
    starts = np.ones(len(keys), bool)
    starts[1:] = keys[1:] != keys[:-1]
    first = order[starts]
    counts = np.diff(np.append(np.flatnonzero(starts), len(keys)))
    return hashes[first], text[first], counts


def prob_min_hash(
    hashes: np.ndarray, text: np.ndarray, weights: np.ndarray, texts: int, registers: int
) -> np.ndarray:
    """For each text and register, the shingle whose arrival there is the earliest."""
    times = np.full(texts * registers, np.inf)
    winners = np.zeros(texts * registers, np.uint64)
    latest = np.full(texts, np.inf)
    time = np.zeros(len(hashes))
    seed = hashes
    while len(hashes):
        seed = mix(seed + _STEP)
        uniform = ((seed >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53
        time = time - np.log(uniform) / weights
        alive = time < latest[text]
        hashes, text, weights = hashes[alive], text[alive], weights[alive]
        time, seed = time[alive], seed[alive]
        place = (mix(seed ^ _OTHER) % np.uint64(registers)).astype(np.int64) + text * registers
        np.minimum.at(times, place, time)
        won = times[place] == time
        winners[place[won]] = hashes[won]
        seen = np.zeros(texts, bool)
        seen[text] = True
        seen = np.flatnonzero(seen)
        latest[seen] = times.reshape(texts, registers)[seen].max(axis=1)
    return winners.reshape(texts, registers)


def band_hashes(winners: np.ndarray, bands: int = BANDS) -> np.ndarray:
    texts = len(winners)
    rows = winners.reshape(texts, bands, -1)
    total = np.tile(np.arange(1, bands + 1, dtype=np.uint64) * _OTHER, (texts, 1))
    for row in range(rows.shape[2]):
        total = mix(total * _STEP + rows[:, :, row])
    return total.view(np.int64)


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replace the text by its band hashes; NULL where there are no words."""
    for batch in batches:
        for row, end, data, offsets in slices(batch.column(3)):
            words = words_of(data, offsets)
            hashes, text, counts = shingle_counts(words)
            winners = prob_min_hash(hashes, text, counts, end - row, BANDS * ROWS)
            flat = band_hashes(winners).ravel()
            found = words.counts > 0
            lists = pa.ListArray.from_arrays(
                pa.array(np.append(0, np.cumsum(found) * BANDS), pa.int32()),
                pa.array(flat[np.repeat(found, BANDS)]),
                mask=pa.array(~found),
            )
            yield pa.RecordBatch.from_arrays(
                [*(column.slice(row, end - row) for column in batch.columns[:3]), lists],
                names=["doc_id", "row_key", "content", "bands"],
            )


def _row_key() -> Column:
    """Equal for equal ids and texts."""
    name = F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit("null"))
    return F.unhex(F.md5(F.concat_ws(":", name, _text())))


def _content() -> Column:
    """Equal for equal texts."""
    return F.unhex(F.md5(_text()))


def _text() -> Column:
    return F.coalesce(F.col("text"), F.lit(""))


# Similarity


def probability_jaccard(
    keys_a: np.ndarray, counts_a: np.ndarray, keys_b: np.ndarray, counts_b: np.ndarray
) -> float:
    """Similarity of two weighted sets, in the time of a sort."""
    above, below = _terms(keys_a, counts_a, keys_b, counts_b)
    return float((above / below).sum())


def is_similar(
    keys_a: np.ndarray, counts_a: np.ndarray, keys_b: np.ndarray, counts_b: np.ndarray
) -> bool:
    """Whether the similarity is the threshold or more; exact where floats can't tell."""
    above, below = _terms(keys_a, counts_a, keys_b, counts_b)
    found = float((above / below).sum())
    if abs(found - THRESHOLD) > SLACK:
        return found > THRESHOLD
    divisor = np.gcd(above, below)
    terms = np.stack([above // divisor, below // divisor])
    terms, times = np.unique(terms, axis=1, return_counts=True)
    total = sum(Fraction(a * n, b) for a, b, n in zip(*terms.tolist(), times.tolist()))
    return total >= EXACT


def _terms(
    keys_a: np.ndarray, counts_a: np.ndarray, keys_b: np.ndarray, counts_b: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Whole numbers whose quotients sum up to the similarity, one for each common key.

    It is the sum over common keys i of 1 / sum_j max(a_j / a_i, b_j / b_i). The first quotient
    is the larger for the j with b_j / a_j below b_i / a_i: with keys ordered by that ratio, the
    inner sum is one of a up to i, and one of b after it.
    """
    keys = np.union1d(keys_a, keys_b)
    a, b = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
    a[np.searchsorted(keys, keys_a)] = counts_a
    b[np.searchsorted(keys, keys_b)] = counts_b
    ratio = np.divide(b, a, out=np.full(len(keys), np.inf), where=a > 0)
    order = np.argsort(ratio)
    a, b = a[order], b[order]
    up_to = np.cumsum(a)
    after = b.sum() - np.cumsum(b)
    common = (a > 0) & (b > 0)
    a, b, up_to, after = a[common], b[common], up_to[common], after[common]
    return a * b, up_to * b + after * a


def _similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of pairs u, v with their texts, those that are similar enough."""
    for batch in batches:
        left, right = _each(batch.column(2)), _each(batch.column(3))
        keep = [is_similar(*a, *b) for a, b in zip(left, right)]
        yield batch.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))


def _each(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The distinct shingles and counts of each text."""
    for row, end, data, offsets in slices(column):
        hashes, text, counts = shingle_counts(words_of(data, offsets))
        order = np.argsort(text, kind="stable")
        cuts = np.searchsorted(text[order], np.arange(end - row + 1))
        for a, b in zip(cuts[:-1], cuts[1:]):
            yield hashes[order[a:b]], counts[order[a:b]]


# Classes


def _kept(frame: DataFrame, new_path: NewPath) -> DataFrame:
    path = new_path()
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def _contents(signed: DataFrame) -> DataFrame:
    """key, content, bands: each text with words once, by its key and by a number."""
    texts = signed.where(F.col("bands").isNotNull()).groupBy(F.col("content").alias("key"))
    texts = texts.agg(F.first("bands").alias("bands"))
    return texts.withColumn("content", F.monotonically_increasing_id())


def _buckets(contents: DataFrame) -> DataFrame:
    """content, bucket: the band buckets that hold several texts."""
    banded = contents.select("content", F.explode("bands").alias("bucket"))
    by_text = Window.partitionBy("bucket").orderBy("content")
    beside = F.coalesce(F.lag("content").over(by_text), F.lead("content").over(by_text))
    return banded.withColumn("beside", beside).where("beside IS NOT NULL").drop("beside")


def _exploded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row, _, data, offsets in slices(batch.column(1)):
            hashes, text, counts = shingle_counts(words_of(data, offsets))
            owner = batch.column(0).take(pa.array(text + row))
            arrays = [owner, pa.array(hashes.view(np.int64)), pa.array(counts)]
            yield pa.RecordBatch.from_arrays(arrays, names=["content", "shingle", "times"])


def _shingles(texts: DataFrame, new_path: NewPath) -> DataFrame:
    kinds = "content long, shingle long, times long"
    return _kept(texts.select("content", "text").mapInArrow(_exploded, kinds), new_path)


def _sizes(shingles: DataFrame) -> DataFrame:
    """content, and of its shingles: all (size), distinct, and those that no other text has."""
    own = shingles.groupBy("shingle").agg(
        F.count("*").alias("holders"),
        F.first("content").alias("content"),
        F.first("times").alias("times"),
    )
    own = own.where("holders = 1").groupBy("content").agg(F.sum("times").alias("own"))
    sizes = shingles.groupBy("content").agg(
        F.sum("times").alias("size"), F.count("*").alias("distinct")
    )
    return sizes.join(own, "content", "left").fillna(0, ["own"])


def _at_most(
    size: Column, own: Column, other_size: Column, other_distinct: Column, other_own: Column
) -> Column:
    """A bound on the similarity of two texts.

    Let u and v be the shares of each text that the other lacks; the similarity is at most
    (1-u)(1-v)/(1-uv). A text lacks what only the other has; and it can't hold more distinct
    shingles of the other than it has shingles that are not its own.
    """
    u = own / size
    v = F.greatest(other_own, other_distinct - (size - own)) / other_size
    v = F.greatest(v, F.lit(0.0))
    # u = v = 1 would divide by zero, and be no link either.
    return F.try_divide((1 - u) * (1 - v), 1 - u * v) + SLACK


def _can_link(members: DataFrame) -> DataFrame:
    """Without the members that can't be similar enough to any text of their bucket."""
    least = members.groupBy("bucket").agg(
        F.min("distinct").alias("least_distinct"), F.max("size").alias("most_size")
    )
    bound = _at_most(
        F.col("size"), F.col("own"), F.col("most_size"), F.col("least_distinct"), F.lit(0)
    )
    kept = members.join(least, "bucket").where(bound >= THRESHOLD)
    return kept.drop("least_distinct", "most_size")


def _pairs(members: DataFrame, centres: DataFrame) -> DataFrame:
    """Pairs u < v of a centre and a member of its bucket that may be linked.

    Of the buckets that two texts share, only the least makes a pair of them.
    """
    centres = centres.select(*(F.col(name).alias(f"c_{name}") for name in ("bucket", *_MEMBER)))
    own, other = ("size", "own"), ("size", "distinct", "own")
    one = _at_most(*(F.col(x) for x in own), *(F.col(f"c_{x}") for x in other))
    two = _at_most(*(F.col(f"c_{x}") for x in own), *(F.col(x) for x in other))
    may = (F.col("label") != F.col("c_label")) & (F.least(one, two) >= THRESHOLD)
    shared = F.array_min(F.array_intersect("buckets", "c_buckets"))
    here = (F.col("bucket") == F.col("c_bucket")) & (F.col("bucket") == shared)
    both = members.join(centres, here & may)
    low, high = F.least("content", "c_content"), F.greatest("content", "c_content")
    return both.select(low.alias("u"), high.alias("v")).distinct()


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    u = texts.select(F.col("content").alias("u"), F.col("text").alias("text_u"))
    v = texts.select(F.col("content").alias("v"), F.col("text").alias("text_v"))
    both = pairs.join(u, "u").join(v, "v").select("u", "v", "text_u", "text_v")
    return both.mapInArrow(_similar, "u long, v long")


def _first_pairs(members: DataFrame, order: Column) -> DataFrame:
    """Each text with one other: the best of the centres of its buckets."""
    centres = members.groupBy("bucket").agg(F.min(order).alias("centre"))
    chosen = members.join(centres, "bucket").groupBy("content")
    chosen = chosen.agg(F.min("centre").alias("best")).select("content", "best.content_of")
    chosen = chosen.where("content_of <> content").withColumnRenamed("content_of", "c")
    low, high = F.least("content", "c"), F.greatest("content", "c")
    return chosen.select(low.alias("u"), high.alias("v")).distinct()


def _joined(labels: DataFrame, links: DataFrame, new_path: NewPath) -> DataFrame:
    """Labels after further links: of the components, as far as they are joined."""
    ends = links.select(F.explode(F.array("u", "v")).alias("content")).distinct()
    every = labels.join(ends, "content", "full")
    every = _kept(every.withColumn("label", F.coalesce("label", "content")), new_path)
    low = every.select(F.col("content").alias("u"), F.col("label").alias("label_u"))
    high = every.select(F.col("content").alias("v"), F.col("label").alias("label_v"))
    across = links.join(low, "u").join(high, "v")
    across = across.select(F.col("label_u").alias("u"), F.col("label_v").alias("v")).distinct()
    moved = connected_components(_kept(across, new_path), new_path)
    moved = moved.select(F.col("node").alias("label"), F.col("label").alias("new"))
    every = every.join(moved, "label", "left")
    return _kept(every.select("content", F.coalesce("new", "label").alias("label")), new_path)


def _mixed(members: DataFrame, labels: DataFrame, tried: int, new_path: NewPath) -> DataFrame:
    """Members with their labels, of buckets that hold several labels and over ``tried`` members."""
    members = members.drop("label").join(labels, "content", "left")
    members = members.withColumn("label", F.coalesce("label", "content"))
    several = members.groupBy("bucket").agg(
        F.min("label").alias("a"), F.max("label").alias("b"), F.count("*").alias("members")
    )
    several = several.where((F.col("a") != F.col("b")) & (F.col("members") > tried))
    return _kept(members.join(several.select("bucket"), "bucket"), new_path)


def _with_buckets(members: DataFrame) -> DataFrame:
    """Members with all buckets that their texts are in."""
    theirs = members.groupBy("content").agg(F.collect_list("bucket").alias("buckets"))
    return members.join(theirs, "content")


def _prefixes(texts: DataFrame, members: DataFrame, new_path: NewPath) -> DataFrame:
    """content, alone, length, shingles: all shingles of each text that may be linked.

    Shingles are ordered by the number of members that hold them. A prefix ends with the shingle
    that takes its weight beyond what linked texts may lack of each other. Those that no other
    member holds come first and are only summed up (``alone``); ``length`` is the number of the
    others. Texts whose prefix has nothing that a text of another label holds are left out.
    """
    theirs = _kept(members.select("content", "label", "size").distinct(), new_path)
    shingles = _shingles(texts.join(theirs.select("content"), "content"), new_path)
    held = shingles.join(theirs, "content")
    spread = held.groupBy("shingle").agg(
        F.count("*").alias("holders"), (F.min("label") != F.max("label")).alias("across")
    )
    rarest = Window.partitionBy("content").orderBy("holders", "shingle")
    before = F.sum("times").over(rarest.rowsBetween(Window.unboundedPreceding, -1))
    held = held.join(spread, "shingle").withColumn("before", F.coalesce(before, F.lit(0)))
    inside = F.col("before") <= (1 - THRESHOLD + SLACK) * F.col("size")
    other = F.col("holders") > 1
    prefixes = held.groupBy("content").agg(
        F.sum(F.when(inside & ~other, F.col("times")).otherwise(0)).alias("alone"),
        F.count_if(inside & other).alias("length"),
        F.sort_array(F.collect_list(F.struct("holders", "shingle", "times"))).alias("shingles"),
        F.max(inside & F.col("across")).alias("across"),
    )
    return prefixes.where("across").drop("across")


def _merged(members: DataFrame, new_path: NewPath) -> DataFrame:
    """Members with buckets that common texts connect as one, if that has fewer pairs.

    Either way, any two texts that share a bucket do so afterwards.
    """
    counts = members.groupBy("bucket").agg(
        F.min("content").alias("least"), F.count("*").alias("members")
    )
    counts = _kept(counts, new_path)
    edges = members.join(counts, "bucket").where("content <> least")
    edges = edges.select(F.col("content").alias("u"), F.col("least").alias("v")).distinct()
    groups = _kept(connected_components(_kept(edges, new_path), new_path), new_path)
    groups = groups.select(F.col("node").alias("content"), F.col("label").alias("merged"))
    pairs = counts.join(groups, F.col("least") == F.col("content")).groupBy("merged")
    pairs = pairs.agg(F.sum(F.col("members") * F.col("members")).alias("pairs"))
    texts = groups.groupBy("merged").agg(F.count("*").alias("texts"))
    fewer = pairs.join(texts, "merged").where(F.col("texts") * F.col("texts") <= F.col("pairs"))
    members = members.join(groups.join(fewer.select("merged"), "merged"), "content", "left")
    members = members.withColumn("bucket", F.coalesce("merged", "bucket"))
    return _kept(members.drop("merged").distinct(), new_path)


def _dealt(members: DataFrame) -> DataFrame:
    """Members of the larger buckets, once for each pair of blocks that theirs is in."""
    counts = members.groupBy("bucket").agg(
        F.count("*").alias("members"), F.sum("distinct").alias("held")
    )
    blocks = F.greatest(F.col("members") / BLOCK, F.col("held") / BLOCK_SHINGLES)
    large = counts.where(F.col("members") > FEW).select("bucket", F.ceil(blocks).alias("blocks"))
    dealt = _with_buckets(members.join(large, "bucket"))
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("content", "bucket"), "blocks"))
    dealt = dealt.withColumn("beside", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return dealt.select(
        "bucket",
        F.least("block", "beside").alias("low"),
        F.greatest("block", "beside").alias("high"),
        "block",
        *("content", "label", "size", "buckets"),
    )


def _by_prefix(table: pa.Table) -> pa.Table:
    """Links u < v that connect the members of two blocks, as far as their texts are similar.

    Prefixes tell which pairs may be. Of the buckets that two texts share, only the least compares
    them. Members of one label are connected already.
    """
    block = table["block"].to_numpy()
    left = np.flatnonzero(block == table["low"][0].as_py())
    right = np.flatnonzero(block == table["high"][0].as_py())
    size = table["size"].to_numpy()
    alone = table["alone"].to_numpy() / size
    every = table["shingles"].combine_chunks()
    cuts = np.append(0, np.cumsum(every.value_lengths().to_numpy()))
    holders, keys, weights = (x.to_numpy() for x in every.flatten().flatten())
    counts = table["length"].to_numpy()
    # A prefix begins after the shingles that no other member holds.
    skipped = np.append(0, np.cumsum(holders == 1))
    begins = cuts[:-1] + skipped[cuts[1:]] - skipped[cuts[:-1]]
    row = np.repeat(np.arange(len(counts)), counts)
    taken = np.arange(len(row)) + np.repeat(begins - np.cumsum(counts) + counts, counts)
    holders, shingle, share = holders[taken], keys[taken], weights[taken] / size[row]
    # Shingles as numbers in their order, and the last that each prefix holds.
    order = np.lexsort((shingle, holders))
    fresh = np.ones(len(order), bool)
    fresh[1:] = shingle[order[1:]] != shingle[order[:-1]]
    place = np.zeros(len(order), np.int64)
    place[order] = np.cumsum(fresh) - 1
    ends = np.cumsum(counts)
    last = place[ends - 1]
    up_to = np.append(0.0, np.cumsum(share))

    def reached(some: np.ndarray, others: np.ndarray) -> np.ndarray:
        """The share of each text that lies no further than the other's prefix."""
        result = np.empty((len(some), len(others)))
        for at, one in enumerate(some):
            start, end = ends[one] - counts[one], ends[one]
            stop = start + np.searchsorted(place[start:end], last[others], "right")
            result[at] = alone[one] + up_to[stop] - up_to[start]
        return result

    lacks = reached(left, right), reached(right, left)
    number = np.full(len(counts), -1), np.full(len(counts), -1)
    number[0][left], number[1][right] = np.arange(len(left)), np.arange(len(right))
    sides = [(n[row] >= 0) for n in number]
    common = np.intersect1d(place[sides[0]], place[sides[1]])
    for begin in range(0, len(common), WIDTH):
        some = common[begin : begin + WIDTH]
        column = np.searchsorted(some, place)
        known = some[np.minimum(column, len(some) - 1)] == place
        tables = []
        for n, side in zip(number, sides):
            used = np.flatnonzero(known & side)
            shares = np.zeros((n.max() + 1, len(some)))
            shares[n[row[used]], column[used]] = share[used]
            tables.append(shares)
        a, b = tables
        lacks[0][:] -= a @ (b > 0).T
        lacks[1][:] -= b @ (a > 0).T
    u, v = np.maximum(lacks[0], 0.0), np.maximum(lacks[1].T, 0.0)
    # As in _at_most, without its quotient.
    may = (u < 1) & ((1 - u) * (1 - v) >= (THRESHOLD - SLACK) * (1 - u * v))
    if table["low"][0] == table["high"][0]:
        may = np.triu(may)
    labels = table["label"].combine_chunks().dictionary_encode().indices.to_numpy()
    may &= labels[left][:, None] != labels[right][None, :]
    here, buckets = table["bucket"][0].as_py(), [set(x) for x in table["buckets"].to_pylist()]
    parent, links = list(range(len(counts))), []

    def root(label: int) -> int:
        while parent[label] != label:
            parent[label] = label = parent[parent[label]]
        return label

    for i, j in np.argwhere(may):
        a, b = left[i], right[j]
        one, two = root(labels[a]), root(labels[b])
        if one == two or min(buckets[a] & buckets[b]) != here:
            continue
        u, v = (slice(cuts[x], cuts[x + 1]) for x in (a, b))
        if is_similar(keys[u], weights[u], keys[v], weights[v]):
            parent[one] = two
            links.append((a, b))
    ends = np.sort(table["content"].to_numpy()[np.array(links, np.int64).reshape(-1, 2)], axis=1)
    return pa.table({"u": ends[:, 0], "v": ends[:, 1]})


def _labels(docs: DataFrame, signed: DataFrame, new_path: NewPath) -> DataFrame:
    """content, label: equal labels for texts that links connect, where there are any."""
    contents = _kept(_contents(signed), new_path)
    labels = _labels_of_numbers(docs, contents, new_path)
    # Shorter than a key, so that no text has it.
    label = F.unhex(F.hex("label")).alias("label")
    return labels.join(contents, "content").select(F.col("key").alias("content"), label)


def _labels_of_numbers(docs: DataFrame, contents: DataFrame, new_path: NewPath) -> DataFrame:
    buckets = _kept(_buckets(contents), new_path)
    wanted = contents.join(buckets.select("content").distinct(), "content")
    texts = docs.select(_content().alias("key"), "text")
    texts = texts.join(wanted.select("key", "content"), "key").groupBy("key")
    texts = texts.agg(F.first("content").alias("content"), F.first("text").alias("text"))
    texts = _kept(texts.drop("key"), new_path)
    sizes = _sizes(_shingles(texts, new_path)).withColumn("label", F.col("content"))
    members = _kept(_can_link(buckets.join(sizes, "content")), new_path)
    # The members with the least of their own come first: what others were made from.
    order = F.struct(
        (F.col("own") / F.col("size")).alias("share"), F.col("content").alias("content_of")
    )
    first = _kept(_first_pairs(members, order), new_path)
    links = _kept(_verified(first, texts), new_path)
    labels = _joined(members.select("content", "label").where("false"), links, new_path)
    members = _mixed(members, labels, 1, new_path)
    if members.isEmpty():
        return labels
    place = F.row_number().over(Window.partitionBy("bucket").orderBy(order))
    members = _kept(_with_buckets(members).withColumn("place", place), new_path)
    texts = _kept(texts.join(members.select("content").distinct(), "content"), new_path)
    centres = members.where(F.col("place") <= CENTRES)
    second = _kept(_pairs(members, centres).join(first, ["u", "v"], "left_anti"), new_path)
    links = _kept(_verified(second, texts), new_path)
    if not links.isEmpty():
        labels = _joined(labels, links, new_path)
    # With as many centres as members, less one, all pairs of a bucket have been tried.
    members = _mixed(members.drop("place", "buckets"), labels, CENTRES + 1, new_path)
    if members.isEmpty():
        return labels
    prefixes = _kept(_prefixes(texts, members, new_path), new_path)
    members = _merged(members.join(prefixes.select("content"), "content"), new_path)
    in_blocks = _dealt(members).join(prefixes, "content").groupBy("bucket", "low", "high")
    links = _kept(in_blocks.applyInArrow(_by_prefix, "u long, v long"), new_path)
    small = members.groupBy("bucket").agg(F.count("*").alias("members"))
    small = small.where(F.col("members") <= FEW).select("bucket")
    small = _with_buckets(members.join(small, "bucket"))
    pairs = _pairs(small, small)
    for tried in (first, second):
        pairs = pairs.join(tried, ["u", "v"], "left_anti")
    links = links.union(_verified(_kept(pairs, new_path), texts))
    links = _kept(links, new_path)
    return labels if links.isEmpty() else _joined(labels, links, new_path)


def near_duplicates(docs: DataFrame, new_path: NewPath) -> DataFrame:
    """Per document: its class, that is the smallest id in it, the class's rows, and its keys.

    ``kept`` marks the representative. ``new_path`` names a new folder in shared storage at
    each call.
    """
    keyed = docs.select(
        F.col("doc_id").cast("long"),
        _row_key().alias("row_key"),
        _content().alias("content"),
        "text",
    )
    kinds = "doc_id long, row_key binary, content binary, bands array<long>"
    signed = _kept(keyed.mapInArrow(_bands, kinds), new_path)
    labels = _labels(docs, signed, new_path)
    rows = signed.select("doc_id", "row_key", "content", F.col("bands").isNull().alias("alone"))
    rows = rows.join(labels, "content", "left")
    # Rows without words are classes of their own.
    alone = F.when(F.col("alone"), F.col("row_key")).otherwise(F.coalesce("label", "content"))
    rows = _kept(rows.select("doc_id", "row_key", alone.alias("label")), new_path)
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row_key")).alias("first")
    classes = rows.groupBy("label").agg(first, F.count("*").alias("class_size"))
    return rows.join(classes, "label").select(
        "doc_id",
        F.col("first.doc_id").alias("class_id"),
        "class_size",
        (F.col("row_key") == F.col("first.row_key")).alias("kept"),
        "row_key",
        F.col("first.row_key").alias("class_key"),
    )


def near_duplicate_keys(docs: DataFrame, new_path: NewPath) -> tuple[Column, DataFrame]:
    """A key of rows, and for the keys in classes of several rows: row_key, class_key."""
    several = near_duplicates(docs, new_path).where("class_size > 1")
    return _row_key(), _kept(several.select("row_key", "class_key").distinct(), new_path)


def first_of_each(docs: DataFrame, new_path: NewPath) -> DataFrame:
    """One document of each class, with all its columns, whatever their names."""
    winners = near_duplicates(docs, new_path).where("kept").select("row_key").distinct()
    winners = _kept(winners.withColumnRenamed("row_key", "__key"), new_path)
    packed = docs.select(
        F.struct(*docs.columns).alias("__row"),
        _row_key().alias("__key"),
    )
    one = packed.join(winners, "__key").groupBy("__key").agg(F.first("__row").alias("__row"))
    return one.select("__row.*")
