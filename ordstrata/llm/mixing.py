"""Mix of overlapping sources to target weights: a min-cost flow from patterns of membership to
sources, then documents in a seeded order."""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Mapping
from fractions import Fraction
from itertools import accumulate, cycle

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordstrata.llm.common import stored

WORD = r"[^\x20\x09-\x0D]+"
# The flow is solved on the driver: a row for each set of sources that some document is in.
MOST_PATTERNS = 100_000
# A step of the search for a cut reads three of the 15 + 16 digits of a row's place in the order,
# and the search ends where this few rows are left.
DIGITS, KEY_DIGITS, ROW_DIGITS, FEW_ROWS = 3, 15, 16, 50_000
# Documents that fill up what a cut between whole documents leaves of a pattern's quota.
FILLERS = 4
SEPARATOR = "\u001f"

Targets = Callable[[Mapping[str | None, int]], Mapping[str | None, Fraction]]


def in_order(sources) -> list[str | None]:
    """By code point, null last."""
    return sorted(sources, key=lambda s: (s is None, s or ""))


def ranked_targets(
    weights: tuple[int, ...] = (3, 1, 2),
    share: Fraction = Fraction(3, 2),
    most_repeats: int = 2,
) -> Targets:
    """Sources in order weigh ``weights``, again and again, and share ``share`` of all sizes; none
    gets more than ``most_repeats`` times its size, and what is over goes to the others by weight."""

    def targets(sizes: Mapping[str | None, int]) -> dict[str | None, Fraction]:
        open_weights = dict(zip(in_order(sizes), cycle(weights)))
        left = share * sum(sizes.values())
        found = {}
        while open_weights:
            unit = left / sum(open_weights.values())
            full = [s for s, w in open_weights.items() if w * unit > most_repeats * sizes[s]]
            if not full:
                return found | {s: w * unit for s, w in open_weights.items()}
            for s in full:
                found[s] = Fraction(most_repeats * sizes[s])
                left -= found[s]
                del open_weights[s]
        return found

    return targets


def cheapest_flow(
    sizes: list[int], members: list[list], quotas: Mapping, most_repeats: int
) -> list[dict]:
    """Tokens that each pattern gives each of its sources: as much of the quotas as can be met, with
    the least repetition.

    A pattern's tokens cost more each time they are used again, so costs are convex. They lie on
    the arcs into the patterns only; so the cheapest augmenting paths are those of the first use
    until there are none, then those of the second, and so on. A path may take tokens back from one
    source to give them to another.
    """
    wanted = dict(quotas)
    given: list[dict] = [{} for _ in sizes]
    users: dict = {}
    for p, sources in enumerate(members):
        for s in sources:
            users.setdefault(s, []).append(p)
    for _ in range(most_repeats):
        spare = list(sizes)
        while path := _path(spare, members, users, given, wanted):
            amount = min(spare[path[0]], wanted[path[-1]])
            steps = list(zip(path[::2], path[1::2]))
            back = list(zip(path[2::2], path[1::2]))
            amount = min([amount, *(given[p][s] for p, s in back)])
            for p, s in steps:
                given[p][s] = given[p].get(s, 0) + amount
            for p, s in back:
                given[p][s] -= amount
            spare[path[0]] -= amount
            wanted[path[-1]] -= amount
    return given


def _path(spare, members, users, given, wanted) -> list | None:
    """The shortest way pattern, source, …, source from spare tokens to an unmet quota."""
    before_pattern = {p: None for p, n in enumerate(spare) if n}
    before_source: dict = {}
    todo = deque(before_pattern)
    while todo:
        p = todo.popleft()
        for s in members[p]:
            if s in before_source:
                continue
            before_source[s] = p
            if wanted[s]:
                path = [s, p]
                while (s := before_pattern[path[-1]]) is not None:
                    path += [s[0], before_source[s[0]]]
                return path[::-1]
            for q in users[s]:
                if q not in before_pattern and given[q].get(s):
                    before_pattern[q] = (s,)
                    todo.append(q)
    return None


def n_words(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _measured(docs: DataFrame, sources: Column, seed: str, carried: bool) -> DataFrame:
    """(doc_id, size, sources, pattern, line): ``line`` is a row's place in the seeded order, from
    doc_id and size, and from its place in the table only among rows that agree in both."""
    row = [F.struct("*").alias("row")] if carried else []
    sized = docs.select(
        "doc_id", n_words().alias("size"), F.array_sort(F.array_distinct(sources)).alias("sources"), *row
    )
    named = F.transform("sources", lambda s: F.coalesce(F.concat(F.lit("="), s), F.lit("-")))
    said = F.concat_ws(
        ":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.col("size")
    )
    key = F.substring(F.md5(said), 1, KEY_DIGITS)
    place = F.lpad(F.hex(F.xxhash64(F.monotonically_increasing_id())), ROW_DIGITS, "0")
    return stored(
        sized.withColumns(
            {"pattern": F.array_join(named, SEPARATOR), "line": F.concat(key, F.lower(place))}
        )
    )


def _borders(rows: DataFrame, goals: list[tuple[str, int, int]]) -> dict[tuple[str, int], tuple]:
    """For every (pattern, cut, goal) the line of the row that first takes the sum of sizes of its
    pattern, in order, beyond ``goal``, and the sum before it.

    The digits of the line are searched from the front: sums by the next digits tell where the cut
    falls, and only rows there are looked at next. So a task never sorts more than ``FEW_ROWS`` rows
    of a pattern, however many it has.
    """
    spark = rows.sparkSession
    found: dict[tuple[str, int], tuple] = {}
    todo = [(pattern, cut, goal, "", 0) for pattern, cut, goal in goals]
    schema = "pattern string, cut int, goal long, prefix string, before long"
    depth = 0
    while todo:
        cuts = F.broadcast(spark.createDataFrame(todo, schema))  # MOST_PATTERNS bounds it
        near = rows.filter("size > 0").join(cuts, "pattern").filter(F.startswith("line", "prefix"))
        digits = F.substring("line", depth + 1, DIGITS) if depth < KEY_DIGITS + ROW_DIGITS else F.lit("")
        sums = near.groupBy("pattern", "cut", "goal", "before", digits.alias("next")).agg(
            F.sum("size").alias("size"), F.count("*").alias("n")
        )
        hit = _first_beyond(sums, "next", "size", "n").collect()  # one row for each cut
        depth += DIGITS
        prefix_of = {(pattern, cut): prefix for pattern, cut, _, prefix, _ in todo}
        deeper = [
            (h.pattern, h.cut, h.goal, prefix_of[h.pattern, h.cut] + h.next, h.upto - h.size)
            for h in hit
        ]
        if all(h.n <= FEW_ROWS for h in hit) or depth > KEY_DIGITS + ROW_DIGITS:
            last = F.broadcast(spark.createDataFrame(deeper, schema))
            few = rows.filter("size > 0").join(last, "pattern").filter(F.startswith("line", "prefix"))
            for h in _first_beyond(few, "line", "size").collect():
                found[h.pattern, h.cut] = (h.line, h.upto - h.size)
            return found
        todo = deeper
    return found


def _first_beyond(rows: DataFrame, order: str, size: str, *more: str) -> DataFrame:
    upto = F.expr(f"before + sum({size}) OVER (PARTITION BY pattern, cut ORDER BY {order})")
    beyond = rows.withColumn("upto", upto).filter("upto > goal")
    first = F.min_by(F.struct(order, size, "upto", "goal", *more), order).alias("first")
    return beyond.groupBy("pattern", "cut").agg(first).select("pattern", "cut", "first.*")


def _fillers(rows: DataFrame, gaps: dict[str, tuple[str, int]]) -> dict[str, list[str]]:
    """Lines of rows behind the border of a pattern that fill its gap: each time the largest that
    fits, and at last the nearest, which may go beyond it by less than it left open."""
    picked: dict[str, list[str]] = {pattern: [] for pattern in gaps}
    for k in range(1, FILLERS + 1):
        room = {p: gap if k < FILLERS else 2 * gap - 1 for p, (_, gap) in gaps.items() if gap > 0}
        if not room:
            break
        wanted = rows.sparkSession.createDataFrame(
            [(p, *gaps[p], most, picked[p]) for p, most in room.items()],
            "pattern string, border string, gap long, most long, picked array<string>",
        )
        fits = (
            rows.filter((F.col("size") > 0) & (F.col("size") <= max(room.values())))
            .join(F.broadcast(wanted), "pattern")
            .filter("size <= most AND line >= border AND NOT array_contains(picked, line)")
        )
        off = F.abs(F.col("gap") - F.col("size")).alias("off")
        best = F.min(F.struct(off, "size", "line")).alias("best")
        for hit in fits.groupBy("pattern").agg(best).collect():
            border, gap = gaps[hit.pattern]
            gaps[hit.pattern] = (border, gap - hit.best["size"])
            picked[hit.pattern].append(hit.best.line)
    return picked


def mix(
    docs: DataFrame,
    sources: Column,
    targets: Targets,
    seed: str = "mix",
    most_repeats: int = 2,
    carried: bool = False,
) -> tuple[DataFrame, dict[str | None, int], Mapping[str | None, Fraction]]:
    """Rows (doc_id, size, sources, copies, taken_for) for all ``docs`` (doc_id, text), with the size
    of every source and its target. ``sources`` gives the array of sources a document is in, which
    may overlap and may hold null; ``targets`` gives the words wanted of each source.

    ``copies`` is how often the mix takes the document, ``most_repeats`` at most, and ``taken_for``
    how many of these copies count for which source. Documents are counted by the set of their
    sources. A flow gives the words of each set to its sources; then the words of a set are cut
    between whole documents in an order that ``seed``, doc_id and size decide, and up to four
    documents fill what is left before the last cut. So the sums miss the targets by less than half a
    document, and the same table gives the same mix however it is stored.

    A null or blank text has size 0 and is taken, if at all, without a word. A row without doc_id
    is ordered by its size alone; repeated rows are told apart by their place only, which no
    column shows. A document in no source is not taken. An empty table gives no rows. More than
    ``MOST_PATTERNS`` sets of sources raise an error. Further columns are not read, or with
    ``carried`` kept as they are in a struct ``row``.
    """
    rows = _measured(docs, sources, seed, carried)
    counted = rows.groupBy("pattern").agg(F.any_value("sources").alias("sources"), F.sum("size").alias("n"))
    patterns = sorted(counted.limit(MOST_PATTERNS + 1).collect(), key=lambda p: p.pattern)
    if len(patterns) > MOST_PATTERNS:
        raise ValueError(f"more than {MOST_PATTERNS} sets of sources")
    sizes: dict[str | None, int] = {}
    for p in patterns:
        for s in p.sources or ():
            sizes[s] = sizes.get(s, 0) + p.n
    wanted = targets(sizes)
    members = [in_order(p.sources or ()) for p in patterns]
    quotas = {s: int(wanted.get(s, 0)) for s in sizes}
    flow = cheapest_flow([p.n for p in patterns], members, quotas, most_repeats)
    ends = {}
    for p, names, given in zip(patterns, members, flow):
        upto = accumulate(given.get(s, 0) for s in names)
        ends[p.pattern] = [(s, *divmod(end, max(p.n, 1))) for s, end in zip(names, upto)]
    goals = [(p, i, rest) for p, cuts in ends.items() for i, (_, _, rest) in enumerate(cuts) if rest]
    borders = _borders(rows, goals)
    last = {p: len(cuts) - 1 for p, cuts in ends.items()}
    gaps = {p: (borders[p, i][0], rest - borders[p, i][1]) for p, i, rest in goals if i == last[p]}
    picked = _fillers(rows, gaps)
    plan = [
        (p, [(s, whole, borders.get((p, i), ("",))[0]) for i, (s, whole, _) in enumerate(cuts)], picked.get(p, []))
        for p, cuts in ends.items()
    ]
    schema = "pattern string, cuts array<struct<source string, whole int, border string>>, picked array<string>"
    cuts = F.broadcast(rows.sparkSession.createDataFrame(plan, schema))  # MOST_PATTERNS bounds it
    more = F.array_contains("picked", F.col("line")).cast("int")
    upto = F.transform(
        "cuts",
        lambda cut, i: cut["whole"]
        + F.greatest(
            (F.col("line") < cut["border"]).cast("int"),
            F.when(i == F.size("cuts") - 1, more).otherwise(0),
        ),
    )
    counted = rows.join(cuts, "pattern").withColumn("upto", upto)
    taken_for = F.transform(
        "cuts",
        lambda cut, i: F.struct(
            cut["source"].alias("source"),
            (F.get("upto", i) - F.coalesce(F.get("upto", i - 1), F.lit(0))).alias("copies"),
        ),
    )
    kept = ["doc_id", "size", "sources", *["row"] * carried]
    copies = F.when(F.size("upto") > 0, F.array_max("upto")).otherwise(0)
    return counted.select(*kept, copies.alias("copies"), taken_for.alias("taken_for")), sizes, wanted


def mixed(docs: DataFrame, sources: Column, targets: Targets, **options) -> DataFrame:
    """The documents of the mix with all their columns, each as often as it is taken."""
    rows, _, _ = mix(docs, sources, targets, carried=True, **options)
    repeated = rows.select("row", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))))
    return repeated.select("row.*")


def mix_sources(docs: DataFrame, targets: Targets | None = None, seed: str = "mix") -> DataFrame:
    """doc_id, size, source_size, target and taken of every row of ``docs`` (doc_id, text, source),
    for the mix by :func:`ranked_targets`. Null is a source like others."""
    rows, sizes, wanted = mix(docs, F.array("source"), targets or ranked_targets(), seed)
    shown = [(s, n, float(wanted[s])) for s, n in sizes.items()]
    table = docs.sparkSession.createDataFrame(shown, "source string, source_size long, target double")
    own = F.get("sources", F.lit(0))
    return rows.withColumn("own", own).join(
        F.broadcast(table), F.col("own").eqNullSafe(F.col("source"))
    ).select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))
