"""Operator 1: personal data by gradient boosting over candidate spans.

Base spans (e-mail, IP address, payment card, phone) come from fixed patterns and
checks and always stay.  High-recall generators propose further, overlapping
spans: loose addresses, dotted numbers, digit runs in any grouping, spelled-out
addresses.  Gradient-boosted trees score each proposal by its format and its
surroundings; a threshold per kind, calibrated on rows the trees did not see,
selects what is added.  The trees learn from the proposals themselves: one whose
normalised form passes a base check is a positive, any other a negative, and one
inside a base span is neither.  Normalised means: (at) and (dot) are replaced and
any letter counts as a plain one; a card's digits may stand in groups between
equal separators; a phone needs no '+' where a word announces it or where it is
grouped as (555) 123-4567.  The trees see the normalised form, so nothing tells
them a base form from a near one.  They are
fitted on every proposal of three quarters of the table's spans and calibrated on every
proposal of the others: proposals that look alike (the same features and label) are
counted first and weigh as many as they are.  They are applied as one SQL expression, so
finding and scoring are narrow passes of JVM expressions over every whole text; only the
counts are shuffled.

Spans are code points, the end exclusive.  All patterns read a text in linear
time: runs are possessive, and a match may begin only where a run begins or the
last match ended, which changes no leftmost match.  So do the steps after them, but
for a logarithm: places are running sums made by doubling, repeats are sorted
neighbours, and whether a proposal lies in a base span is a binary search among the
spans' starts with the running maximum of their ends.

Defined results: a null text is empty: no span, and the hash of the empty list;
a null id is returned as it is; repeated rows are answered each; equal spans of
several generators are one, and spans that begin alike go by kind, then end (ties); a
very long text, or one that is nothing but spans, is read whole; without
proposals of both classes nothing is added; an empty table gives an empty table;
other columns are never read.
"""

from __future__ import annotations

from math import isqrt

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelfold.llm.common import text_of, through_table

KINDS = ("email", "ip", "card", "phone")

# The base patterns, with possessive runs and run starts.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# The generators, (kinds proposed, pattern, what a text must hold to be searched).
GENERATORS = (
    (("email",), r"(?:\G|(?<![^\s@,;<>()]))[^\s@,;<>()]++@[^\s@,;<>()]+(?<![.:!?])", "@"),
    (("email",), r"(?i)(?:\G|(?<![a-z0-9._%+-]))[a-z0-9._%+-]++ ?[(\[] ?at ?[)\]] ?[a-z0-9-]++"
                 r"(?:(?:\.| \. | ?[(\[] ?dot ?[)\]] ?| dot )[a-z0-9-]++)++", "at"),
    (("ip",), r"(?<![0-9.])[0-9]++(?:\.[0-9]++)++", "."),
    (("card", "phone"), r"(?<![0-9])[+(]?[0-9][\x20().0-9-]{4,}[0-9]", ""),
    (("card", "phone"), r"(?<![0-9])[0-9]{7,}+", ""),
    (("phone",), r"(?<![0-9(])\(?[0-9]{3}\)?[\x20.-]{1,2}[0-9]{3}[\x20.-][0-9]{4}(?![0-9])", ""),
)
FEATURES = ("kind", "length", "digits", "letters", "dots", "dashes", "blanks", "brackets", "announced", "at", "luhn",
            "parts", "small_parts", "ending", "left_word", "right_word", "context")
FORMS = 50_000  # fixed value: different proposals that one task fits
# Words that announce personal data.
CONTEXT = r"(?i)(?:mail|contact|phone|tel|call|fax|mobile|card|visa|credit|ip|host|addr)[^\n]{0,16}$"
# Words that announce a phone number, and groups that only phone numbers have.
PHONE_WORD = (r"(?i)(?<!\p{L})(?:tel|t[eé]l[eé](?:f|ph)on[eo]?|phone|call|fax|mobile|m[oó]vil|cell|handy|contact|"
              r"whatsapp|sms)(?!\p{L})[^\n0-9]{0,12}$")
PHONE_GROUPS = r"^(?:1[\x20.-])?\(?[0-9]{3}\)?[\x20.-]{1,2}[0-9]{3}[\x20.-][0-9]{4}$"
# Fixed value: a card's digits in one run, or in groups between equal separators.
CARD_GROUPS = r"^(?:[0-9]+|[0-9]{3,7}([\x20.-]{1,2})[0-9]{3,7}(?:\1[0-9]{3,7})*)$"


def spans_of(text: str, pattern: str, when: Column, context: bool = False) -> Column:
    """Leftmost non-overlapping matches as array<struct<s, e, t>>, with context also what stands
    left (l) and right (r).  Lengths of the matches and of what stands between them add up to places."""
    kind = "array<struct<s:int,e:int,t:string" + (",l:string,r:string" if context else "") + ">>"
    found = F.when(when, F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0)))
    # arrays of one struct, so that the split and the sums are made once and only where something was found
    both = F.array(F.struct(F.split(F.col(text), pattern, -1).alias("p"), found.alias("m")))

    def summed(x: Column) -> Column:
        return F.struct(x["p"].alias("p"), x["m"].alias("m"), running(
            F.transform(x["m"], lambda m, i: F.char_length(F.get(x["p"], i)) + F.char_length(m)), False).alias("e"))

    def placed(x: Column) -> Column:
        def span(m: Column, i: Column) -> Column:
            end = F.get(x["e"], i)
            sides = [F.right(F.get(x["p"], i), F.lit(24)).alias("l"), F.left(F.get(x["p"], i + 1), F.lit(1)).alias("r")]
            return F.struct((end - F.char_length(m)).alias("s"), end.alias("e"), m.alias("t"), *(sides if context else []))
        return F.transform(x["m"], span)

    spans = F.element_at(F.transform(F.transform(both, summed), placed), 1)
    return F.coalesce(F.when(F.size(found) > 0, spans), F.array().cast(kind))


def running(values: Column, highest: bool) -> Column:
    """Running sums (or maxima) of an array of numbers from 0 on: in step k each takes in what stands 2**k
    places before it, so n numbers take n log n additions; a fold that appends would copy n * n."""
    def step(acc: Column, k: Column) -> Column:
        shift = F.least(F.call_function("shiftleft", F.lit(1), k), F.size(acc))
        earlier = F.concat(F.array_repeat(F.lit(0), shift), F.slice(acc, F.lit(1), F.size(acc) - shift))
        return F.zip_with(acc, earlier, (lambda x, y: F.greatest(x, y)) if highest else (lambda x, y: x + y))

    return F.aggregate(F.sequence(F.lit(0), F.length(F.bin(F.size(values)))), values, step)


def places_below(starts: Column, limit: Column) -> Column:
    """How many of the ascending starts lie below a number, by binary search."""
    bits = F.length(F.bin(F.size(starts)))
    steps = F.transform(F.sequence(F.lit(1), bits), lambda b: F.call_function("shiftleft", F.lit(1), bits - b))
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(
        F.coalesce(F.get(starts, at + step - 1) < limit, F.lit(False)), at + step).otherwise(at))


def without_repeats(sorted_array: Column) -> Column:
    """A sorted array, equal neighbours once."""
    once = F.transform(F.array(sorted_array), lambda a: F.filter(a, lambda x, i: (i == 0) | ~x.eqNullSafe(F.get(a, i - 1))))
    return F.element_at(once, 1)


def _digits(t: Column) -> Column:
    return F.regexp_replace(t, "[^0-9]", "")


def luhn(t: Column) -> Column:
    """Whether the digits of a text pass the Luhn check."""
    d = F.split(F.reverse(_digits(t)), "")
    total = F.aggregate(F.transform(d, lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(
        c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0))), F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0)))
    return total % 10 == 0


def small_parts(t: Column) -> Column:
    """Whether every dotted part is at most 255."""
    return F.forall(F.split(t, r"\."), lambda x: (F.length(F.ltrim(x, F.lit("0"))) <= 3)
                    & (F.coalesce(F.right(x, F.lit(3)).try_cast("int"), F.lit(0)) <= 255))


def _valid(kind: str, t: Column) -> Column:
    n = F.length(_digits(t))
    if kind == "ip":
        return small_parts(t)
    if kind == "card":
        return n.between(14, 19) & luhn(t)
    return n.between(10, 15) if kind == "phone" else F.lit(True)


def _normal(kind: str, t: Column) -> Column:
    """What the trees see of a proposal: the form that its kind's base pattern would read."""
    if kind == "email":
        for pattern, mark in ((r"(?i) ?[(\[] ?at ?[)\]] ?", "@"),
                              (r"(?i) ?[(\[] ?dot ?[)\]] ?| dot | \. ", "."), (r"\p{L}", "a")):
            t = F.regexp_replace(t, pattern, mark)
    elif kind == "card":
        t = F.regexp_replace(t, r"[\x20.()-]+", " ")
    elif kind == "phone":
        t = F.regexp_replace(t, r"^\+", "")
    return t


def _features(kind: int, c: Column, t: Column) -> list[Column]:
    """FEATURES of a proposal and whether its normalised form t passes a base check."""
    name, raw, count = KINDS[kind], c["t"], lambda p: F.regexp_count(t, F.lit(p))
    digits, left, right = count("[0-9]"), c["l"].rlike("[A-Za-z0-9._%+-]$"), c["r"].rlike("^[A-Za-z0-9]")
    quad = (F.size(F.split(t, r"\.")) == 4) & small_parts(t)
    announced, is_luhn, small, good = F.lit(False), F.lit(False), F.lit(False), F.lit(False)
    if name == "email":
        good = t.rlike("^[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:[.][A-Za-z0-9-]+)*[.][A-Za-z]{2,24}$")
    elif name == "ip":
        small = small_parts(t)
    elif name == "card":
        is_luhn = luhn(t)
        good = raw.rlike(CARD_GROUPS) & _valid(name, t) & ~left & ~right
    else:
        announced = raw.startswith("+") | c["l"].rlike(PHONE_WORD) | raw.rlike(PHONE_GROUPS)
        is_luhn, small = (digits >= 14) & luhn(t), quad
        good = announced & _valid(name, t) & ~is_luhn & ~quad & ~left & ~right
    values = (F.lit(kind), F.char_length(t), digits, count("[A-Za-z]"), count(r"\."), count("-"), count(" "),
              count("[()]"), announced, count("@"), is_luhn, F.size(F.split(t, r"\.")), small,
              t.rlike(r"\.[A-Za-z]{2,24}$"), left, right, c["l"].rlike(CONTEXT))
    return [v.cast("double").alias(f) for f, v in zip(FEATURES, values)] + [good.alias("good")]


def find_candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    keep_text: bool = False) -> DataFrame:
    """(id, base array<struct<s,k,e>>, more array<struct<s,k,e,features,good>>[, text]) of every row."""
    d = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    digit = F.col("has_digit")
    d = d.withColumn("has_digit", F.col("text").rlike("[0-9]"))
    needs = {"email": F.col("text").contains("@"), "ip": digit, "card": digit,
             "phone": digit & F.col("text").contains("+")}
    d = d.select("*", *[spans_of("text", BASE[k], needs[k]).alias(f"b_{k}") for k in KINDS],
                 *[spans_of("text", p, F.col("text").contains(has) if has == "@" else
                            F.col("text").rlike(r"(?i)[(\[] ?at ?[)\]]") if has == "at" else digit,
                            context=True).alias(f"g_{i}") for i, (_, p, has) in enumerate(GENERATORS)])

    def passing(i: int) -> Column:
        return F.transform(F.filter(f"b_{KINDS[i]}", lambda c: _valid(KINDS[i], c["t"])), lambda c: F.struct(
            c["s"].alias("s"), F.lit(i).alias("k"), c["e"].alias("e")))

    def proposed(i: int, k: int) -> Column:
        # an array of one form, so that it is made once
        return F.transform(f"g_{i}", lambda c: F.element_at(F.transform(F.array(_normal(KINDS[k], c["t"])), lambda t: (
            F.struct(c["s"].alias("s"), F.lit(k).alias("k"), c["e"].alias("e"), *_features(k, c, t)))), 1))

    base = F.array_sort(F.concat(*[passing(i) for i in range(len(KINDS))]))
    more = F.concat(*[proposed(i, KINDS.index(k)) for i, (kinds, _, _) in enumerate(GENERATORS) for k in kinds])
    d = d.select("id", "text", base.alias("base"), more.alias("more"))
    ends = F.transform("base", lambda b: b["e"])
    d = d.withColumn("b", F.struct(F.transform("base", lambda b: b["s"]).alias("s"), running(ends, True).alias("top")))
    # what stands inside a base span is covered: no proposal
    more = F.filter("more", lambda c: ~_inside(c, F.col("b")))
    more = F.transform(more, lambda c: c.withField("equal", _among(c, F.col("b"))))
    return d.select("id", "base", without_repeats(F.array_sort(more)).alias("more"), *(["text"] if keep_text else []))


def _inside(c: Column, b: Column) -> Column:
    """Whether a span covers all of a proposal and more; b: the spans' starts and the running maximum of their ends."""
    before, upto = places_below(b["s"], c["s"]), places_below(b["s"], c["s"] + 1)
    return F.coalesce(F.get(b["top"], before - 1) >= c["e"], F.lit(False)) | F.coalesce(
        F.get(b["top"], upto - 1) > c["e"], F.lit(False))


def _among(c: Column, b: Column) -> Column:
    """Whether a proposal is a base span; spans with its start are one per kind at most."""
    near = F.slice("base", places_below(b["s"], c["s"]) + 1, F.lit(len(KINDS)))
    return F.exists(near, lambda x: (x["s"] == c["s"]) & (x["k"] == c["k"]) & (x["e"] == c["e"]))


def _tree_sql(node, at: str) -> str:
    if node.getClass().getSimpleName() == "LeafNode":
        return repr(float(node.prediction())) + "D"
    split = node.split()
    return (f"if({at}.{FEATURES[split.featureIndex()]} <= {float(split.threshold())!r}D, "
            f"{_tree_sql(node.leftChild(), at)}, {_tree_sql(node.rightChild(), at)})")


def count_proposals(found: DataFrame) -> DataFrame:
    """(held, label, FEATURES, n): every proposal, counted by what the trees see of it; a quarter of the
    spans, by hash, is held back for the calibration."""
    return (found.select("id", F.explode("more").alias("c")).select("id", "c.*")
            .withColumn("label", (F.col("equal") | F.col("good")).cast("double"))
            .withColumn("held", F.expr("pmod(xxhash64(id, s, e, k), 4) = 0"))
            .groupBy("held", "label", *FEATURES).agg(F.count(F.lit(1)).cast("double").alias("n")))


def fit_trees(found: DataFrame, rounds: int = 8, depth: int = 3,
              precision: float = 0.99) -> tuple[str, list[float]] | None:
    """(score expression over a proposal ``c``, threshold of each kind), or None without both classes."""
    counted = through_table(count_proposals(found), "pii-counts")
    learn, check = counted.filter("NOT held"), counted.filter("held")
    size = learn.agg(F.count(F.lit(1)).alias("forms"), F.sum("n").alias("n"), F.countDistinct("label").alias("labels")).first()
    if size.labels < 2:
        return None
    # few forms are fitted in one order on every run; bins enough that Spark reads all of them for the splits
    learn = learn.repartition(1 + size.forms // FORMS, *FEATURES).sortWithinPartitions("label", *FEATURES)
    bins = max(32, isqrt(size.forms) + 1) if size.forms > 10_000 else 32
    model = GBTClassifier(labelCol="label", featuresCol="f", weightCol="n", maxIter=rounds, maxDepth=depth, stepSize=0.4,
                          seed=1, maxBins=bins, minWeightFractionPerNode=min(0.49, 4.5 / size.n)).fit(
        VectorAssembler(inputCols=list(FEATURES), outputCol="f").transform(learn))
    raw = " + ".join(f"{w!r}D * ({_tree_sql(t._java_obj.rootNode(), 'c')})"
                     for t, w in zip(model.trees, model.treeWeights))
    score = f"1D / (1D + exp(-2D * ({raw})))"
    # calibration: the lowest score from which on the share of positives reaches the precision
    # (the trees' leaves give few different scores, however many proposals)
    curve = (check.select(F.struct(*FEATURES).alias("c"), "label", "n")
             .select(F.expr(score).alias("score"), "label", "n", F.col("c.kind").cast("int").alias("k"))
             .groupBy("k", "score").agg(F.sum(F.col("label") * F.col("n")).alias("good"), F.sum("n").alias("n"))
             .orderBy("k", F.desc("score")).collect())
    limits = [2.0] * len(KINDS)
    good, n = [0.0] * len(KINDS), [0] * len(KINDS)
    for r in curve:
        good[r.k] += r.good
        n[r.k] += r.n
        if good[r.k] >= precision * n[r.k] and r.score >= 0.5:
            limits[r.k] = r.score
    return score, limits


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = False,
             **fit) -> DataFrame:
    """One row per document: id, base and spans as array<struct<s,k,e>>, sorted[, text]."""
    found = through_table(find_candidates(docs, id_col, text_col, keep_text), "pii-found")
    model = fit_trees(found, **fit)
    plain = "array<struct<s:int,k:int,e:int>>"
    if model is None:
        added = F.array().cast(plain)
    else:
        score, limits = model
        limit = "CASE c.k " + " ".join(f"WHEN {k} THEN {x!r}D" for k, x in enumerate(limits)) + " END"
        added = F.expr(f"transform(filter(more, c -> {score} >= {limit}), "
                       "c -> named_struct('s', c.s, 'k', c.k, 'e', c.e))")
    return found.select(F.col("id").alias(id_col), "base",
                        without_repeats(F.array_sort(F.concat("base", added.cast(plain)))).alias("spans"),
                        *(["text"] if keep_text else []))


def listed(spans: str) -> Column:
    """kind:start:end of every span, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda c: F.concat_ws(":", F.get(names, c["k"]), c["s"], c["e"])), ",")


def pii_digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **fit) -> DataFrame:
    """One row per document: id, base counts, base_sha256, spans."""
    counts = [F.expr(f"size(filter(base, c -> c.k = {k}))").cast("long").alias(f"n_{name}")
              for k, name in enumerate(KINDS)]
    return find_pii(docs, id_col, text_col, **fit).select(
        id_col, *counts, F.sha2(listed("base"), 256).alias("base_sha256"), listed("spans").alias("spans"))


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **fit) -> DataFrame:
    """One row per document: id and its text with every selected span replaced by its kind in
    brackets; of overlapping spans the first names the whole stretch."""
    found = find_pii(docs, id_col, text_col, keep_text=True, **fit)
    found = found.withColumn("top", running(F.transform("spans", lambda c: c["e"]), True))
    # one character each where spans are many: cutting a string begins at its start every time
    many = F.size("spans") > 64
    chars = F.when(many, F.split("text", ""))

    def cut(start: Column, end: Column) -> Column:
        return F.when(many, F.array_join(F.slice("chars", start + 1, end - start), "")).otherwise(
            F.substring("text", start + 1, end - start))

    names = F.array(*[F.lit(f"[{k}]") for k in KINDS])
    before = lambda i: F.coalesce(F.get("top", i - 1), F.lit(0))  # noqa: E731  where the stretch before a span ends
    pieces = F.transform("spans", lambda c, i: F.when(c["s"] >= before(i), F.concat(cut(before(i), c["s"]), F.get(names, c["k"]))))
    last = before(F.size("spans"))
    return found.withColumn("chars", chars).select(
        id_col, F.concat(F.array_join(F.filter(pieces, lambda p: p.isNotNull()), ""), cut(last, F.char_length("text"))).alias("text"))
