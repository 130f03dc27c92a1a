"""Mix of overlapping sources to target weights, by min-cost flow over membership patterns.

Documents are aggregated by the set of sources they belong to. The words of a pattern are
offered once at no cost and again at a cost that rises with every repetition; a min-cost flow
routes them to the quotas of the sources. The flow of a pattern then says how often each of its
documents is taken: all of them a whole number of times, and the first ones in a seeded order
once more.

Only one row per pattern reaches the driver (at most ``MAX_PATTERNS``, more is an error). The
seeded order is cut by two histograms of 4096 bins and one last bin, so nothing is sorted as a
whole, and the plan is one threshold per pattern: documents are never joined or shuffled.

Defined results: a null text has size 0 and takes 0 words; a null source is a source of its own
and comes last; of rows with equal id and text as many are taken once more as the target has room
for, no matter which; texts are read whole; without rows the result is empty. Other columns of the
input are left alone, whatever their names, but ``mix_...`` columns are replaced.
"""

from __future__ import annotations

import heapq
import json
from collections import defaultdict

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql import types as T

from filmdw.llm.words import text_or_empty, word_count
from filmdw.session import write_stage

MAX_PATTERNS = 200_000
MAX_TIMES = 3
SEED = 20
BIN_BITS, ORDER_BITS = 12, 63


def shares(sizes: dict, weights: dict, most: int = MAX_TIMES) -> dict:
    """Target of each source: its weight's part of all words, at most ``most`` times its size.

    What a source cannot take is shared again by weight among the others until none is above.
    """
    left, open_sources, target = float(sum(sizes.values())), list(sizes), {}
    while open_sources:
        total = sum(weights[s] for s in open_sources)
        full = [s for s in open_sources if left * weights[s] / total > most * sizes[s]]
        if not full:
            target.update({s: left * weights[s] / total for s in open_sources})
            break
        for source in full:
            target[source] = float(most * sizes[source])
        left -= sum(target[s] for s in full)
        open_sources = [s for s in open_sources if s not in target]
    return target


def _groups(members: dict) -> list[list]:
    """Patterns that share sources, directly or through others."""
    of_source, seen, groups = defaultdict(list), set(), []
    for pattern, sources in members.items():
        for source in sources:
            of_source[source].append(pattern)
    for first in members:
        if first in seen:
            continue
        seen.add(first)
        queue, group = [first], []
        while queue:
            pattern = queue.pop()
            group.append(pattern)
            for source in members[pattern]:
                for other in of_source.pop(source, ()):
                    if other not in seen:
                        seen.add(other)
                        queue.append(other)
        groups.append(group)
    return groups


class _Flow:
    """Min-cost flow by successive cheapest paths with node potentials."""

    def __init__(self):
        self.arcs = defaultdict(list)

    def add(self, a, b, room, cost):
        forth, back = [b, room, cost, None], [a, 0.0, -cost, None]
        forth[3], back[3] = back, forth
        self.arcs[a].append(forth)
        self.arcs[b].append(back)
        return forth

    def run(self, start, end, least):
        high = defaultdict(int)
        while True:
            far, came, queue, n = {start: 0}, {}, [(0, 0, start)], 0
            while queue:
                d, _, a = heapq.heappop(queue)
                if d > far[a]:
                    continue
                for arc in self.arcs[a]:
                    b, room, cost, _ = arc
                    e = d + cost + high[a] - high[b]
                    if room > least and e < far.get(b, float("inf")):
                        far[b], came[b], n = e, (a, arc), n + 1
                        heapq.heappush(queue, (e, n, b))
            if end not in far:
                return
            for node in list(self.arcs):
                high[node] += min(far.get(node, far[end]), far[end])
            path, node = [], end
            while node != start:
                node, arc = came[node]
                path.append(arc)
            amount = min(arc[1] for arc in path)
            for arc in path:
                arc[1] -= amount
                arc[3][1] += amount


def route(sizes: dict, members: dict, quotas: dict, most: int = MAX_TIMES) -> dict:
    """(pattern, source) -> words, of least total repetition cost: the n-th repeat costs n - 1."""
    flows = {}
    for group in _groups(members):
        sources = sorted({s for p in group for s in members[p]}, key=lambda s: (s is None, s or ""))
        net, routed = _Flow(), {}
        for p in group:
            for n in range(most):
                net.add("from", ("p", p), float(sizes[p]), n)
            for s in members[p]:
                routed[p, s] = net.add(("p", p), ("s", s), float(most * sizes[p]), 0)
        for s in sources:
            net.add(("s", s), "to", float(quotas[s]), 0)
        net.run("from", "to", 1e-6)
        flows.update({key: arc[3][1] for key, arc in routed.items()})
    return flows


def _keyed(docs: DataFrame, doc_id: str, text: str, memberships: Column, seed: int) -> list[Column]:
    order = F.xxhash64(F.lit(seed), F.col(doc_id), text_or_empty(F.col(text)))
    return [
        F.to_json(F.array_sort(F.array_distinct(memberships))).alias("_pattern"),
        word_count(F.col(text)).alias("_size"),
        F.shiftrightunsigned(order, 1).alias("_order"),
        # tells equal rows apart; the rows are written before it is used
        F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.monotonically_increasing_id()), 1).alias("_tie"),
    ]


def _edge(rows: DataFrame, place: str) -> DataFrame:
    """(_pattern, place, _words, _to, _extra): the places near the ``_extra`` words of a pattern, each with
    its words and those up to it, from the bin that holds the last of them."""
    first, second = ORDER_BITS - BIN_BITS, ORDER_BITS - 2 * BIN_BITS
    rows = rows.where("_extra > 0")
    for bits in (first, second):
        bins = rows.groupBy("_pattern", F.shiftright(place, bits).alias("_bin")).agg(
            F.sum("_size").alias("_words"), F.first("_extra").alias("_extra")
        )
        before = Window.partitionBy("_pattern").orderBy("_bin")
        edge = (
            bins.withColumn("_to", F.sum("_words").over(before))
            .where("_to >= _extra AND _to - _words < _extra")
            .select("_pattern", "_bin", (F.col("_extra") - F.col("_to") + F.col("_words")).alias("_rest"))
        )
        rows = (
            rows.withColumn("_bin", F.shiftright(place, bits))
            .join(F.broadcast(edge), ["_pattern", "_bin"])
            .select("_pattern", place, "_size", F.col("_rest").alias("_extra"))
        )
    each = rows.groupBy("_pattern", place).agg(
        F.sum("_size").alias("_words"), F.first("_extra").alias("_extra")
    )
    order = Window.partitionBy("_pattern").orderBy(place)
    return each.withColumn("_to", F.sum("_words").over(order))


def _last(place: str, taken: Column) -> Column:
    """The last place that is taken: at least the one before the last bin, as earlier bins are taken whole."""
    return F.coalesce(F.max(F.when(taken, F.col(place))), F.min(place) - 1)


def _cuts(rows: DataFrame, extra: DataFrame) -> DataFrame:
    """(_pattern, _cut, _next, _tie_cut): places up to ``_cut`` are taken once more, and of the rows at
    ``_next``, the first that does not fit whole, those up to ``_tie_cut``."""
    rows = rows.join(F.broadcast(extra), "_pattern")
    over = F.struct(F.col("_order").alias("place"), (F.col("_extra") - F.col("_to") + F.col("_words")).alias("left"))
    cuts = _edge(rows, "_order").groupBy("_pattern").agg(
        _last("_order", F.col("_to") <= F.col("_extra")).alias("_cut"),
        F.min(F.when(F.col("_to") > F.col("_extra"), over)).alias("_over"),
    )
    cuts = write_stage(cuts.select("_pattern", "_cut", F.col("_over.place").alias("_next"), "_over.left"), "mix-cuts")
    ties = (
        rows.drop("_extra")
        .join(F.broadcast(cuts.where("_next IS NOT NULL")), "_pattern")
        .where("_order = _next")
        .select("_pattern", "_tie", "_size", F.col("left").alias("_extra"))
    )
    tie_cuts = _edge(ties, "_tie").groupBy("_pattern").agg(
        _last("_tie", F.col("_to") - F.col("_words") / 2 <= F.col("_extra")).alias("_tie_cut")
    )
    return cuts.drop("left").join(F.broadcast(tie_cuts), "_pattern", "left")


def _mixed(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    memberships: Column | None = None,
    weights=None,
    most: int = MAX_TIMES,
    seed: int = SEED,
) -> DataFrame:
    """(_doc, mix_size, mix_copies, mix_source_size, mix_target), the columns of ``docs`` in one."""
    spark = docs.sparkSession
    memberships = F.array(F.col("source")) if memberships is None else memberships
    weights = weights or (lambda names: {s: 1 + i % 3 for i, s in enumerate(names)})
    keys = _keyed(docs, doc_id, text, memberships, seed)
    rows = write_stage(docs.select(F.struct("*").alias("_doc"), *keys), "mix")
    stats = rows.groupBy("_pattern").agg(F.sum("_size").alias("n")).limit(MAX_PATTERNS + 1).collect()
    if len(stats) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} membership patterns")
    sizes = {r["_pattern"]: r["n"] for r in stats}
    members = {p: json.loads(p) for p in sizes}
    # a document of several sources is shared out evenly for their sizes
    of_source = defaultdict(float)
    for pattern, sources in members.items():
        for source in sources:
            of_source[source] += sizes[pattern] / len(sources)
    names = sorted(of_source, key=lambda s: (s is None, s or ""))
    of_source = {s: of_source[s] for s in names}
    targets = shares(of_source, weights(names), most)
    flows, taken = route(sizes, members, targets, most), defaultdict(float)
    for (pattern, _), words in flows.items():
        taken[pattern] += words
    plan = []
    for pattern, size in sizes.items():
        whole = min(int((taken[pattern] + 1e-6) // size), most) if size else 0
        extra = max(0.0, taken[pattern] - whole * size) if size and whole < most else 0.0
        of = members[pattern]
        plan.append(
            (pattern, whole, extra, float(sum(of_source[s] for s in of)), float(sum(targets[s] for s in of)))
        )
    table = _small(spark, plan)
    cuts = _cuts(rows, table.select("_pattern", "_extra"))
    table = write_stage(table.join(cuts, "_pattern", "left"), "mix-plan")
    tied = (F.col("_order") == F.col("_next")) & (F.col("_tie") <= F.col("_tie_cut"))
    once_more = F.coalesce((F.col("_order") <= F.col("_cut")) | tied, F.lit(False)).cast("int")
    return rows.join(F.broadcast(table), "_pattern").select(
        "_doc",
        F.col("_size").alias("mix_size"),
        (F.col("_whole") + once_more).alias("mix_copies"),
        F.col("_source_size").alias("mix_source_size"),
        F.col("_target").alias("mix_target"),
    )


def mix(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with mix_size, mix_copies (0 to ``most``), mix_source_size and mix_target.

    ``memberships`` is an array of the sources of a document, which may overlap; by default its
    ``source``. ``weights`` gives the weight of each source from their sorted list. mix_source_size
    and mix_target sum over the sources of a document.
    """
    rows = _mixed(docs, **options)
    added = rows.columns[1:]
    kept = [F.col("_doc")[c].alias(c) for c in docs.columns if c not in added]
    return rows.select(*kept, *added)


def _small(spark: SparkSession, plan: list) -> DataFrame:
    schema = T.StructType(
        [
            T.StructField("_pattern", T.StringType()),
            T.StructField("_whole", T.IntegerType()),
            T.StructField("_extra", T.DoubleType()),
            T.StructField("_source_size", T.DoubleType()),
            T.StructField("_target", T.DoubleType()),
        ]
    )
    return spark.createDataFrame(plan, schema)


def take(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus: each document as often as the mix takes it, in its own columns."""
    taken = _mixed(docs, **options).where("mix_copies > 0")
    times = F.explode(F.sequence(F.lit(1), F.col("mix_copies"))).alias("_time")
    return taken.select("_doc", times).select(*[F.col("_doc")[c].alias(c) for c in docs.columns])
