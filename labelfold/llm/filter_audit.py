"""Operator 13: how filters interact, by recursive CTE enumeration of their orders.

Every document gets a mask: one bit per filter that it fails.  Masks are counted
into cells (part, mask, labels); a part has at most 2**filters x 4 of them, however
many documents it holds.  A recursive CTE starts with the empty prefix of every
part and extends it with each letter not used yet: a level joins the letters whose
bit is not applied, carries the applied bits and the part's cells on, and emits
the metrics of that step.  Prefixes of full length are the orders; the metrics of
an order's step k are those of its first k letters.

Filters (letters A to E; words are runs of other than U+0020 and U+0009 to U+000D):
A under 50 words, B distinct words under 65 % of the words, C capitals A-Z over 5 %
of the code points, D holds one of # $ % & * |, E repeats the text of a smaller id.
A to D are expressions over the whole text in the scan.  For E texts meet by their
SHA-256: rows are counted per (text, id), then per (text, part, mask, labels) with
the smallest id and its count, so a text that a third of all rows repeat is a few
rows from every task, and the smallest id of a text is a window over those few.

The recursion reads the cells from a written table.  A session may limit the rows
of a recursion: parts are dealt into as many recursive queries as keep each under
the default of a million rows.

Defined results: a null text is empty (fails A alone, and E as an empty text may);
a null source is the part ''; a null id is never smaller or larger than another, so
it fails E never and has no labels; rows that repeat an id and text are documents
each and do not fail E through one another (ties); an id with several labels counts
as good or toxic when one of them says so; an empty table gives no rows; other
columns are never read.
"""

from __future__ import annotations

from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelfold.llm.common import SPACE, text_of, through_table

LETTERS = "ABCDE"
#: Rows of one recursion, below Spark's default limit of a million.
RECURSION_ROWS = 600_000


def failure_mask(text: Column) -> Column:
    """Bits of the filters A to D that a text fails (A 1, B 2, C 4, D 8)."""
    # an array of one array, so that the words are cut once
    words = F.filter(F.split(text, SPACE), lambda w: w != "")
    n = F.element_at(F.transform(F.array(words), lambda w: F.struct(
        F.size(w).cast("long").alias("all"), F.size(F.array_distinct(w)).cast("long").alias("kinds"))), 1)
    counted = F.struct(n.alias("n"))
    capitals = F.char_length(text) - F.char_length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    bits = F.element_at(F.transform(F.array(counted), lambda c: (
        F.when(c["n"]["all"] < 50, 1).otherwise(0)
        + F.when(c["n"]["kinds"] * 100 < c["n"]["all"] * 65, 2).otherwise(0))), 1)
    return (bits + F.when(capitals.cast("long") * 100 > F.char_length(text).cast("long") * 5, 4).otherwise(0)
            + F.when(text.rlike(r"[#$%&*|]"), 8).otherwise(0)).cast("int")


def filter_cells(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 part_col: str = "source") -> DataFrame:
    """(part, mask, good, toxic, n): documents of a part by failed filters (E is bit 16) and labels."""
    d = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                    text_of(text_col).alias("text"))
    d = d.select("id", "part", F.unhex(F.sha2("text", 256)).alias("th"), failure_mask(F.col("text")).alias("mask"))
    # ids that are null meet no label; their texts spread them
    d = d.withColumn("salt", F.when(F.col("id").isNull(), F.xxhash64("th")).otherwise(F.lit(0).cast("long")))
    known = (labels.select(F.col(id_col).alias("id"), (F.col("quality") == 1).alias("good"), (F.col("toxic") == 1).alias("toxic"))
             .filter(F.col("id").isNotNull()).groupBy("id").agg(F.max("good").alias("good"), F.max("toxic").alias("toxic"))
             .withColumn("salt", F.lit(0).cast("long")))
    d = (d.join(known, ["id", "salt"], "left")
         .select("id", "part", "th", "mask", *[F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")]))
    same = d.groupBy("th", "id", "part", "mask", "good", "toxic").agg(F.count(F.lit(1)).alias("c"))
    met = (same.groupBy("th", "part", "mask", "good", "toxic", F.col("id").isNull().alias("no_id"))
           .agg(F.sum("c").alias("n"), F.min(F.struct("id", "c")).alias("least")))
    met = met.withColumn("first", F.expr("min(least.id) OVER (PARTITION BY th)"))
    stays = F.when(F.col("no_id"), F.col("n")).when(F.col("least.id") == F.col("first"), F.col("least.c")).otherwise(0)
    split = met.select("part", "good", "toxic", F.inline(F.array(
        F.struct(F.col("mask"), stays.cast("long").alias("n")),
        F.struct((F.col("mask") + 16).alias("mask"), (F.col("n") - stays).cast("long").alias("n")))))
    return split.filter("n > 0").groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n"))


def enumerate_prefixes(cells: DataFrame, letters: str = LETTERS) -> DataFrame:
    """(part, prefix, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost) for every
    ordered choice of letters, by one recursive query over (part, cells) rows (the i-th letter is bit i)."""
    bits = ", ".join(f"('{x}', {1 << i})" for i, x in enumerate(letters))

    def total(condition: str) -> str:
        return f"aggregate(filter(s.cells, c -> {condition}), 0L, (a, c) -> a + c.n)"

    fails, free = "(c.mask & l.bit) <> 0", "(c.mask & s.applied) = 0"
    return cells.sparkSession.sql(f"""
        WITH RECURSIVE steps(part, prefix, step, applied, cells, kept, removed, redundant, unique_fails, good_lost,
                             toxic_lost) AS (
          SELECT part, '', 0, 0, cells, 0L, 0L, 0L, 0L, 0L, 0L FROM {{cells}}
          UNION ALL
          SELECT s.part, concat(s.prefix, l.letter), s.step + 1, s.applied | l.bit, s.cells,
                 {total("(c.mask & (s.applied | l.bit)) = 0")}, {total(f"{fails} AND {free}")},
                 {total(f"{fails} AND NOT {free}")}, {total("c.mask = l.bit")},
                 {total(f"{fails} AND {free} AND c.good")}, {total(f"{fails} AND {free} AND c.toxic")}
          FROM steps s JOIN (VALUES {bits}) AS l(letter, bit) ON (s.applied & l.bit) = 0)
        SELECT part, prefix, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost
        FROM steps WHERE step > 0""", cells=cells)


def audit_orders(cells: DataFrame, letters: str = LETTERS) -> DataFrame:
    """Metrics of every step of every order of the filters, per part, with each filter's shapley sum."""
    n = len(letters)
    packed = through_table(cells.groupBy("part").agg(F.collect_list(F.struct("mask", "good", "toxic", "n")).alias("cells")),
                           "audit-cells")
    rows = 1 + sum(factorial(n) // factorial(n - k) for k in range(1, n + 1))
    chunks = max(1, -(-packed.count() * rows // RECURSION_ROWS))
    levels = None
    for k in range(chunks):
        own = packed if chunks == 1 else packed.filter(F.pmod(F.xxhash64("part"), F.lit(chunks)) == k)
        found = enumerate_prefixes(own, letters)
        levels = found if levels is None else levels.unionByName(found)
    levels = through_table(levels, "audit-steps")

    # a prefix of k letters begins (n - k)! orders
    orders_of = F.element_at(F.array(*[F.lit(factorial(n - k)) for k in range(1, n + 1)]), F.col("step"))
    shapley = (levels.groupBy("part", F.right("prefix", F.lit(1)).alias("letter"))
               .agg(F.sum(F.col("removed") * orders_of).alias("shapley")))
    orders = (levels.filter(F.col("step") == n).select("part", F.col("prefix").alias("filter_order"))
              .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(n))))
              .withColumn("prefix", F.expr("left(filter_order, step)"))
              .withColumn("letter", F.expr("substring(filter_order, step, 1)")))
    metrics = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"]
    return (orders.join(levels.drop("step"), ["part", "prefix"]).join(shapley, ["part", "letter"])
            .select("part", "filter_order", F.col("step").cast("int").alias("step"), *metrics, "shapley"))


def audit_filters(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  part_col: str = "source") -> DataFrame:
    """The five filters over documents: one row per part, filter order and step."""
    return audit_orders(filter_cells(docs, labels, id_col, text_col, part_col))


FILTER_AUDIT_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
firsts AS (SELECT text, min(doc_id) AS first FROM d GROUP BY 1),
lab AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY 1),
m AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
        CASE WHEN len(ws) < 50 THEN 1 ELSE 0 END
        + CASE WHEN 100 * len(list_distinct(ws)) < 65 * len(ws) THEN 2 ELSE 0 END
        + CASE WHEN 100 * length(regexp_replace(d.text, '[^A-Z]', '', 'g')) > 5 * length(d.text) THEN 4 ELSE 0 END
        + CASE WHEN regexp_matches(d.text, '[#$%&*|]') THEN 8 ELSE 0 END
        + CASE WHEN d.doc_id > first THEN 16 ELSE 0 END AS mask
      FROM d JOIN firsts ON firsts.text = d.text LEFT JOIN lab ON lab.doc_id = d.doc_id),
cell AS (SELECT part, mask, good, toxic, count(*) AS n FROM m GROUP BY ALL),
letter(letter, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
prefix(prefix, before, bit) AS (
  SELECT letter, 0, bit FROM letter
  UNION ALL
  SELECT p.prefix || l.letter, p.before | p.bit, l.bit FROM prefix p JOIN letter l ON ((p.before | p.bit) & l.bit) = 0),
level AS (SELECT part, prefix, bit,
        coalesce(sum(n) FILTER (mask & (before | bit) = 0), 0)::BIGINT AS kept,
        coalesce(sum(n) FILTER (mask & bit <> 0 AND mask & before = 0), 0)::BIGINT AS removed,
        coalesce(sum(n) FILTER (mask & bit <> 0 AND mask & before <> 0), 0)::BIGINT AS redundant,
        coalesce(sum(n) FILTER (mask = bit), 0)::BIGINT AS unique_fails,
        coalesce(sum(n) FILTER (mask & bit <> 0 AND mask & before = 0 AND good = 1), 0)::BIGINT AS good_lost,
        coalesce(sum(n) FILTER (mask & bit <> 0 AND mask & before = 0 AND toxic = 1), 0)::BIGINT AS toxic_lost
      FROM prefix CROSS JOIN cell GROUP BY ALL),
steps AS (SELECT l.part, o.prefix AS filter_order, k.step::INT AS step, l.* EXCLUDE (part, prefix)
          FROM prefix o CROSS JOIN range(1, 6) k(step) JOIN level l ON l.prefix = left(o.prefix, k.step)
          WHERE length(o.prefix) = 5)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley FROM steps
"""
