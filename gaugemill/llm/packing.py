"""Best-fit packing of documents into training sequences, with conflicts.

A bin holds ``CAPACITY`` words. Two documents conflict if they come from one source or are
copies of each other, or near copies; they never share a bin. Documents are spread evenly over
groups of bounded size by a hash of id, text and, for equal rows, their number, whatever their
source, and each group is packed by itself, longest first: the same rows give the same bins in
any layout. Within a group, bins are kept by residual space. Each residual has a bitmap of its bins,
and so has each source and each duplicate cluster: the bins at a residual that can take a
document are a bitwise difference. The search begins at the smallest residual that suffices and
goes on to its successors until a bin is compatible, which is then the tightest one; if none is,
a bin is opened.

A document of more than ``CAPACITY`` words is cut: full pieces fill bins of their own, the rest
is packed like a document. NULL text, and text without words, takes no space and gets no bin:
its row has a NULL bin. A NULL source or cluster conflicts with none. Repeated rows are copies
and are packed each, in different bins. An empty table gives an empty result. Only ``doc_id``,
``text`` and ``source`` are read. ``pack`` keeps texts apart that are equal but for case.
``pack_apart`` keeps near copies apart, too: the bands of ``probminhash`` are clusters, 32 of a
document, and documents that share one never share a bin. Bands cover all near copies, but for
one pair in 20 million at similarity 0.8, and some texts that are less alike. No pairs are made
and nothing is compared.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugemill.llm.probminhash import BANDS, ROWS, band_hashes, prob_min_hash, shingle_counts
from gaugemill.llm.words import slices, words_of

CAPACITY = 1024
GROUP = 4096  # documents packed together, about

WORD = r"[^\x20\x09-\x0D]+"

PACKED = (
    "doc_id string, piece long, first_word long, n_words long, bin string, place int, "
    "bin_words long"
)


class Bins:
    """Open bins, ordered by residual space."""

    def __init__(self) -> None:
        self.count = 0
        self.levels = 0  # bit r: some bin has residual r
        self.at: dict[int, int] = defaultdict(int)  # bitmap of the bins with a residual
        self.of_source: dict[object, int] = defaultdict(int)
        self.of_cluster: dict[object, int] = defaultdict(int)

    def place(self, size: int, source: object, *clusters: object) -> int | None:
        """Put a document into the tightest compatible bin, if there is one."""
        taken = self.of_source.get(source, 0)
        for cluster in clusters:
            taken |= self.of_cluster.get(cluster, 0)
        later = self.levels >> size << size
        while later:
            level = later & -later
            residual = level.bit_length() - 1
            free = self.at[residual] & ~taken
            if free:
                chosen = free & -free
                self._move(chosen, residual, residual - size)
                self._mark(chosen, source, *clusters)
                return chosen.bit_length() - 1
            later ^= level
        return None

    def open(self, residual: int, source: object, *clusters: object) -> int:
        chosen = 1 << self.count
        self.count += 1
        self._move(chosen, None, residual)
        self._mark(chosen, source, *clusters)
        return self.count - 1

    def _move(self, chosen: int, before: int | None, after: int) -> None:
        if before is not None:
            self.at[before] ^= chosen
            if not self.at[before]:
                self.levels ^= 1 << before
        self.at[after] |= chosen
        self.levels |= 1 << after

    def _mark(self, chosen: int, source: object, *clusters: object) -> None:
        if source is not None:
            self.of_source[source] |= chosen
        for cluster in clusters:
            if cluster is not None:
                self.of_cluster[cluster] |= chosen


def best_fit(
    documents: Iterable[tuple], capacity: int
) -> Iterator[tuple[int, int]]:
    """The bin of each (size, source, cluster...), in the order given."""
    bins = Bins()
    for size, source, *clusters in documents:
        found = bins.place(size, source, *clusters)
        if found is None:
            found = bins.open(capacity - size, source, *clusters)
        yield found, size


def pack(
    docs: DataFrame,
    staging: str,
    capacity: int = CAPACITY,
    group: int = GROUP,
    near_copies: bool = False,
) -> DataFrame:
    """A row per piece: its document, where it begins and how long it is, its bin and its place.

    With ``near_copies`` these are a conflict, too. Sizes and clusters are written to
    ``staging``, so that texts are read once.
    """
    spark = docs.sparkSession
    # Ids as text: numbers that can be NULL would become floats in pandas.
    own = docs.select(
        F.col("doc_id").cast("string").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.xxhash64(F.lower("text")).cast("string").alias("copies"),
        F.xxhash64("doc_id", "text").alias("key"),
        F.regexp_count("text", F.lit(WORD)).cast("long").alias("words"),
        F.col("text") if near_copies else F.lit(None).cast("array<long>").alias("bands"),
    )
    if near_copies:
        own = own.mapInArrow(_banded, _SIZES)
    own.write.parquet(f"{staging}/rows")
    rows = spark.read.parquet(f"{staging}/rows")
    groups = -(-rows.count() // group) or 1
    # Equal rows are numbered, so that copies of one document spread over the groups.
    spread = F.xxhash64("key", "source", "number")
    (
        rows.groupBy("doc_id", "source", "copies", "key", "words")
        .agg(F.first("bands").alias("bands"), F.count("*").alias("n"))
        .withColumn("number", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
        .withColumn("spread", spread)
        .withColumn("full", F.coalesce(F.floor((F.col("words") - 1) / capacity), F.lit(0)))
        .withColumn("group", F.pmod("spread", F.lit(groups)))
        .drop("key", "n", "number")
        .write.parquet(f"{staging}/sizes")
    )
    sizes = spark.read.parquet(f"{staging}/sizes")
    rests = sizes.where("words > 0").withColumn(
        "rest", F.col("words") - F.col("full") * capacity
    )
    packed = (
        rests.select("group", "spread", "doc_id", "source", "copies", "bands", "full", "rest")
        .groupBy("group")
        .applyInPandas(_pack_group(capacity), PACKED)
    )
    pieces = F.explode(F.sequence(F.lit(0).cast("long"), F.col("full") - 1)).alias("piece")
    filled = (
        sizes.where("full > 0")
        .select("group", "spread", "doc_id", pieces)
        .select(
            "doc_id",
            "piece",
            (F.col("piece") * capacity).alias("first_word"),
            F.lit(capacity).cast("long").alias("n_words"),
            F.concat_ws("-", "group", F.hex("spread"), "piece").alias("bin"),
            F.lit(0).alias("place"),
            F.lit(capacity).cast("long").alias("bin_words"),
        )
    )
    nothing = F.lit(0).cast("long")
    empty = sizes.where("words is null or words = 0").select(
        "doc_id",
        nothing.alias("piece"),
        nothing.alias("first_word"),
        nothing.alias("n_words"),
        F.lit(None).cast("string").alias("bin"),
        F.lit(None).cast("int").alias("place"),
        nothing.alias("bin_words"),
    )
    every = packed.unionByName(filled).unionByName(empty)
    return every.withColumn("doc_id", F.col("doc_id").cast("long"))


def pack_apart(docs: DataFrame, new_path: Callable[[], str], **sizes: int) -> DataFrame:
    """``pack`` with near copies in different bins."""
    return pack(docs, new_path(), near_copies=True, **sizes)


_SIZES = (
    "doc_id string, source string, copies string, key long, words long, bands array<long>"
)


def _banded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replace the text by its bands; none where there are no words."""
    for batch in batches:
        for row, end, data, offsets in slices(batch.column(5)):
            words = words_of(data, offsets)
            hashes, text, counts = shingle_counts(words)
            bands = band_hashes(prob_min_hash(hashes, text, counts, end - row, BANDS * ROWS))
            found = words.counts > 0
            lists = pa.ListArray.from_arrays(
                pa.array(np.append(0, np.cumsum(found) * BANDS), pa.int32()),
                pa.array(bands.ravel()[np.repeat(found, BANDS)]),
            )
            yield pa.RecordBatch.from_arrays(
                [*(column.slice(row, end - row) for column in batch.columns[:5]), lists],
                names=[*batch.schema.names[:5], "bands"],
            )


def _shared(lists: Iterable) -> list[tuple]:
    """Of each document the bands that another one has, too; others are no conflict here."""
    arrays = [np.zeros(0, np.int64) if x is None else np.asarray(x, np.int64) for x in lists]
    every, counts = np.unique(np.concatenate(arrays), return_counts=True)
    several = every[counts > 1]
    return [tuple(x[np.isin(x, several)].tolist()) for x in arrays]


def _pack_group(capacity: int):
    def pack_group(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(
            ["rest", "doc_id", "spread"], ascending=[False, True, True], kind="stable"
        )
        documents = (
            (size, None if pd.isna(source) else source, copies, *bands)
            for size, source, copies, bands in zip(
                rows["rest"].tolist(), rows["source"], rows["copies"], _shared(rows["bands"])
            )
        )
        bins = np.fromiter((found for found, _ in best_fit(documents, capacity)), np.int64)
        sizes = rows["rest"].to_numpy(np.int64)
        filled = np.bincount(bins, sizes).astype(np.int64)
        label = str(rows["group"].iloc[0])
        return pd.DataFrame(
            {
                "doc_id": rows["doc_id"].to_numpy(),
                "piece": rows["full"].to_numpy(),
                "first_word": rows["full"].to_numpy(np.int64) * capacity,
                "n_words": sizes,
                "bin": [f"{label}-{found}" for found in bins.tolist()],
                "place": pd.Series(bins).groupby(bins).cumcount().to_numpy(np.int32),
                "bin_words": filled[bins],
            }
        )

    return pack_group
