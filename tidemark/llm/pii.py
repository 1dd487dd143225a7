"""Personal data by candidate gradient boosting, in SQL functions only.

High-recall generators propose spans per kind, which may overlap. Spans of the base kinds
that pass their check stay. All other candidates (groups of digits that read like national
phone numbers, identifiers, long tokens that may be credentials) get format and context
features and a score from boosted trees; a threshold per kind, calibrated to a precision
on candidates the trees have not seen, decides. Labels are weak: checks (mod 97 of an IBAN,
the number ranges of an SSN), words such as ``phone:`` and assignments such as
``token = "..."`` label some candidates, the trees generalise to the rest. A candidate that a
rule is sure of is a span whatever the trees say, so a kind too rare to train on is found too.

Training reads the candidates of all texts. Scoring runs the trees as one
SQL expression inside the row, so no document is shuffled and no row leaves the JVM.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import materialize, scratch_dir

# The base kinds, in the order in which spans with one start are listed.
# Quantifiers are possessive and runs are entered at their start only, so that no text
# takes more than linear time; the matches are those of the plain patterns.
LOCAL = r"[A-Za-z0-9._%+-]"
BASE = {
    "email": rf"(?:\G|(?<!{LOCAL})){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Generators of further candidates.
EXTRA = {
    "phone": r"(?<![0-9+])\(?[0-9]{2,4}\)?[\x20.-][0-9]{3,4}[\x20.-][0-9]{3,4}(?![0-9])",
    "id": r"(?<![A-Za-z0-9])(?:[0-9]{3}-[0-9]{2}-[0-9]{4}|[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?)(?![A-Za-z0-9])",
    "secret": r"(?<![A-Za-z0-9_/+=.@-])[A-Za-z0-9_/+=-]{16,}+",
}
KINDS = (*BASE, *(k for k in EXTRA if k not in BASE))
HINTED = r"(?i)(?:token|secret|passw(?:or)?d|pwd|api.?key|key|auth|bearer|ssn|iban|tel|phone)[\x20\"':=]*+$"
CALLED = r"(?i)(?<![a-z])(?:tel(?:ephone)?|(?:tele)?phone|mobile|cell|fax|call)(?:\x20?(?:no|number|nr))?[\x20.:=\"']*+$"
CREDENTIAL = r"(?i)(?:token|secret|passw(?:or)?d|pwd|key)\s?[=:]\s?[\"']?$"
FEATURES = ("kind", "length", "digits", "uppers", "lowers", "marks", "switches", "hinted", "opens", "glued", "checked")
#: Candidates of a training task.
TASK_ROWS = 100_000


class Model(NamedTuple):
    """Trees as ``(weight, nodes)`` and the score threshold of each kind."""

    trees: tuple
    thresholds: dict[int, float]


def _matches(text: Column, pattern: str) -> Column:
    r"""``start, stop, body, before, after`` of all matches, in code points.

    Each piece is the gap up to a match with the match; ``\G`` ties the pieces together,
    so one scan finds them all and the last piece is the rest of the text.
    """
    tied = rf"(?s)\G(.*?)({pattern}|\z)"
    gaps, bodies = F.regexp_extract_all(text, F.lit(tied), F.lit(1)), F.regexp_extract_all(text, F.lit(tied), F.lit(2))
    pieces = F.arrays_zip(gaps.alias("gap"), bodies.alias("body"), F.concat(F.slice(gaps, 2, F.size(gaps)), F.array(F.lit(""))).alias("next"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(
        "array<struct<start:int,stop:int,body:string,before:string,after:string>>").alias("found"))

    def step(acc: Column, p: Column) -> Column:
        begin = acc["at"] + F.length(p["gap"])
        end = begin + F.length(p["body"])
        one = F.struct(begin.alias("start"), end.alias("stop"), p["body"].alias("body"),
                       F.right(p["gap"], F.lit(24)).alias("before"), F.left(p["next"], F.lit(1)).alias("after"))
        return F.struct(end.alias("at"), F.when(p["body"] == "", acc["found"]).otherwise(F.concat(acc["found"], F.array(one))).alias("found"))

    return F.aggregate(pieces, start, step)["found"]


def _digits(body: Column) -> Column:
    return F.regexp_replace(body, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    numbers = F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
        d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(numbers, F.lit(0), lambda a, d: a + F.coalesce(d, F.lit(0))) % 10 == 0


def _valid(kind: str, body: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        part = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
        return body.rlike(rf"^{part}(?:\.{part}){{3}}$")
    n = F.length(_digits(body))
    return n.between(9, 15) if kind == "phone" else n.between(12, 19) & _luhn(_digits(body))


def _iban(body: Column) -> Column:
    """The check digits of an IBAN of 15 to 34 characters hold: modulo 97 the number is 1."""
    plain = F.regexp_replace(body, "\x20", "")
    turned = F.split(F.concat(F.substring(plain, 5, 34), F.left(plain, F.lit(4))), "")
    value = lambda c: F.when(c.rlike("^[0-9]$"), c.cast("int")).otherwise(F.ascii(c) - 55)
    rest = F.aggregate(F.filter(turned, lambda c: c != ""), F.lit(0), lambda a, c: (a * F.when(value(c) > 9, 100).otherwise(10) + value(c)) % 97)
    return body.rlike("^[A-Z]{2}[0-9]{2}") & F.length(plain).between(15, 34) & (rest == 1)


def _id(body: Column) -> Column:
    """An IBAN whose check digits hold, or an SSN of an area, group and number that are given out."""
    return body.rlike("^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}$") | _iban(body)


def _trimmed(m: Column) -> Column:
    """An IBAN that ran on into capitals of the text ends where its check digits hold."""
    ends = [m["body"], *(F.regexp_replace(m["body"], rf"(?:\x20[A-Z0-9]+){{{n}}}$", "") for n in range(1, 6))]
    body = F.coalesce(F.get(F.filter(F.array(*ends), _iban), F.lit(0)), m["body"])
    return F.struct(m["start"].alias("start"), (m["start"] + F.length(body)).alias("stop"), body.alias("body"), m["before"].alias("before"),
                    F.when(body == m["body"], m["after"]).otherwise(F.lit(" ")).alias("after"))


def _share(body: Column, pattern: str) -> Column:
    return F.length(F.regexp_replace(body, pattern, "")) / F.length(body)


def base_spans(text: Column) -> Column:
    """All base matches as an array of ``start, kind, stop, body, valid``, by kind and start."""
    digit = text.rlike("[0-9]")
    found = []
    for number, (kind, pattern) in enumerate(BASE.items()):
        may = text.contains("@") if kind == "email" else text.contains("+") & digit if kind == "phone" else digit
        spans = F.transform(_matches(text, pattern), lambda m: F.struct(
            m["start"].alias("start"), F.lit(number).alias("kind"), m["stop"].alias("stop"), m["body"].alias("body"),
            _valid(kind, m["body"]).alias("valid")))
        found.append(F.when(may, spans))
    return F.array_compact(F.flatten(F.array(*[F.coalesce(f, F.array().cast(
        "array<struct<start:int,kind:int,stop:int,body:string,valid:boolean>>")) for f in found])))


def candidates(text: Column, base: Column) -> Column:
    """Candidates of the further generators with their features and weak labels.

    ``label`` is 1 or 0 where a rule is sure and null where only the trees decide: a
    candidate inside a valid base span of its own kind is personal, one inside another or
    a failed one of its own kind is not; an identifier goes by its check; a number that is
    called a phone number is one; an assigned credential is one, a token without digits
    is none. ``sure`` is a label of 1 outside base spans.
    """
    found = {kind: _matches(text, pattern) for kind, pattern in EXTRA.items()}
    found["id"] = F.transform(found["id"], _trimmed)
    return F.flatten(F.array(*[F.transform(found[kind], _described(kind, base)) for kind in EXTRA]))


def _described(kind: str, base: Column):
    """A candidate of one generator as ``start, number, stop, taken, label`` and features."""
    number = KINDS.index(kind)

    def one(m: Column) -> Column:
        inside = lambda b: (b["start"] < m["stop"]) & (m["start"] < b["stop"])
        taken = F.exists(base, lambda b: inside(b) & b["valid"])
        own = F.exists(base, lambda b: inside(b) & b["valid"] & (b["kind"] == number))
        failed = F.exists(base, lambda b: inside(b) & ~b["valid"] & (b["kind"] == number))
        body, before = m["body"], m["before"]
        label = F.when(own, 1).when(taken | failed, 0)
        checked = F.lit(False)
        if kind == "phone":
            label = F.when(own, 1).when(taken | failed, 0).when(before.rlike(CALLED), 1)
        if kind == "id":
            checked = _id(body)
            label = F.when(checked & ~taken, 1).otherwise(0)
        if kind == "secret":
            sure = before.rlike(CREDENTIAL) | body.rlike("^AKIA[0-9A-Z]{16}$")
            label = F.when(taken, 0).when(sure & body.rlike("[0-9]"), 1).when(~body.rlike("[0-9]"), 0)
        features = {
            "kind": F.lit(number), "length": F.length(body), "digits": _share(body, "[^0-9]"), "uppers": _share(body, "[^A-Z]"),
            "lowers": _share(body, "[^a-z]"), "marks": _share(body, "[A-Za-z0-9]"),
            "switches": F.regexp_count(body, F.lit("[0-9][A-Za-z]|[A-Za-z][0-9]")), "hinted": before.rlike(HINTED).cast("int"),
            "opens": before.rlike("(^|[\\s\"'(=:])$").cast("int"), "glued": m["after"].rlike("[A-Za-z0-9@]").cast("int"),
            "checked": checked.cast("int")}
        return F.struct(m["start"].alias("start"), F.lit(number).alias("number"), m["stop"].alias("stop"), taken.alias("taken"),
                        label.cast("int").alias("label"), F.coalesce(~taken & (label == 1), F.lit(False)).alias("sure"), *[features[f].cast("double").alias(f) for f in FEATURES])

    return one


def _score(c: Column, model: Model) -> Column:
    """The trees' margin as one expression."""
    def walk(nodes: dict, at: int) -> Column:
        node = nodes[at]
        if node["leftChild"] < 0:
            return F.lit(float(node["prediction"]))
        name, cut = FEATURES[node["split"]["featureIndex"]], node["split"]["leftCategoriesOrThreshold"][0]
        return F.when(c[name] <= cut, walk(nodes, node["leftChild"])).otherwise(walk(nodes, node["rightChild"]))

    total = F.lit(0.0)
    for weight, nodes in model.trees:
        total = total + F.lit(float(weight)) * walk(nodes, 0)
    return total


def _read_trees(spark: SparkSession, fitted) -> tuple:
    path = scratch_dir(spark, "trees")
    fitted.write().save(path)
    trees: dict[int, dict] = {}
    for row in spark.read.parquet(f"{path}/data").collect():
        trees.setdefault(row["treeID"], {})[row["nodeData"]["id"]] = row["nodeData"].asDict(recursive=True)
    return tuple((fitted.treeWeights[n], trees[n]) for n in sorted(trees))


def train(docs: DataFrame, text_col: str = "text", precision: float = 0.95,
          rounds: int = 10, depth: int = 3, seed: int = 7) -> Model:
    """Boosted trees over the weakly labelled candidates of all texts that hold a digit; in others there are no spans.

    One half of the candidates trains, the other calibrates: the threshold of a kind is the
    lowest score above which at least ``precision`` of its labelled candidates are personal.
    A kind without such a score, or candidates with a single label, add no spans but those of
    which a rule is sure.
    """
    spark = docs.sparkSession
    text = docs.where(F.col(text_col).rlike("[0-9]")).select(F.col(text_col).alias("text"))
    listed = text.select("text", base_spans(F.col("text")).alias("base")).select(candidates(F.col("text"), F.col("base")).alias("c"))
    # The outer form keeps the optimizer from evaluating all candidates once more as a filter.
    listed = listed.select(F.explode_outer("c").alias("c")).select("c.label", *[f"c.{f}" for f in FEATURES], F.xxhash64("c").alias("h"))
    listed = materialize(listed.where("label IS NOT NULL"), "candidates")
    learn, judge = listed.where("h % 2 = 0"), listed.where("h % 2 != 0")
    if learn.select("label").distinct().count() < 2:
        return Model((), {})
    parts = max(4, learn.count() // TASK_ROWS)
    ready = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(learn)
    fitted = GBTClassifier(labelCol="label", featuresCol="features", maxIter=rounds, maxDepth=depth, seed=seed,
                           minInstancesPerNode=5).fit(ready.repartition(parts, "h"))
    model = Model(_read_trees(spark, fitted), {})
    row = F.struct(*FEATURES)
    scored = judge.select(F.col("kind").cast("int").alias("number"), "label", F.round(_score(row, model), 2).alias("score"))
    steps = scored.groupBy("number", "score").agg(F.sum("label").alias("good"), F.count("*").alias("all")).collect()
    limits: dict[int, float] = {}
    for number in {s["number"] for s in steps}:
        good = total = 0
        for s in sorted((s for s in steps if s["number"] == number), key=lambda s: -s["score"]):
            good, total = good + s["good"], total + s["all"]
            if good >= precision * total:
                limits[number] = s["score"] - 0.005
    return model._replace(thresholds=limits)


def find(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text, base, spans`` per row: valid base spans and all spans.

    Both are arrays of ``start, kind, stop`` (code points, ``stop`` exclusive; ``kind`` is a
    place in ``KINDS``), sorted. Added spans do not overlap base ones. Null text is empty.
    Repeated rows and null ids are rows like others; an empty table gives no rows; other
    columns are ignored.
    """
    text = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    found = text.select("doc_id", "text", base_spans(F.col("text")).alias("all"))
    plain = lambda s, kind: F.struct(s["start"].alias("start"), kind.alias("kind"), s["stop"].alias("stop"))
    empty = F.array().cast("array<struct<start:int,kind:int,stop:int>>")

    def chosen(c: Column) -> Column:
        bar = F.lit(float("inf"))
        for n, v in model.thresholds.items():
            bar = F.when(c["number"] == n, F.lit(v)).otherwise(bar)
        return c["sure"] | ~c["taken"] & (c["digits"] > 0) & (_score(c, model) >= bar)  # no candidate without a digit, in any text

    added = F.transform(F.filter(candidates(F.col("text"), F.col("all")), chosen), lambda c: plain(c, c["number"]))
    added = F.when(F.col("text").rlike("[0-9]"), added).otherwise(empty)
    base = F.transform(F.filter("all", lambda b: b["valid"]), lambda b: plain(b, b["kind"]))
    return found.select("doc_id", "text", F.array_sort(base).alias("base"), added.alias("added")).select(
        "doc_id", "text", "base", F.array_sort(F.concat("base", "added")).alias("spans"))


def listing(spans: Column) -> Column:
    """``kind:start:stop`` of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["stop"].cast("string"))), ",")


def redact(text: Column, spans: Column) -> Column:
    """``text`` with each span replaced by its kind in brackets; of overlapping spans the first counts."""
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        kept = F.substring(text, acc["at"] + 1, s["start"] - acc["at"])
        return F.when(s["start"] < acc["at"], F.struct(F.greatest(acc["at"], s["stop"]).alias("at"), acc["out"].alias("out"))).otherwise(
            F.struct(s["stop"].alias("at"), F.concat(acc["out"], F.array(kept, F.get(names, s["kind"]))).alias("out")))

    done = F.aggregate(spans, start, step)
    rest = F.substring(text, done["at"] + 1, F.length(text))
    return F.when(F.size(spans) == 0, text).otherwise(F.concat(F.array_join(done["out"], ""), rest))


def redacted(docs: DataFrame, model: Model, text_col: str = "text", size_col: str = "n_chars") -> DataFrame:
    """``docs`` with all spans redacted in place and, where there is such a column, the new length.

    Null texts stay null. All columns keep their names, order and types.
    """
    row = docs.select(F.struct("*").alias("row"), F.col(text_col).alias("text"))
    found = find(row.withColumn("doc_id", F.col("row")), model).select(F.col("doc_id").alias("row"), redact(F.col("text"), F.col("spans")).alias("clean"))
    clean = F.when(F.col(f"row.`{text_col}`").isNotNull(), F.col("clean"))
    new = {text_col: clean, size_col: F.length(clean)}
    return found.select(*[new[c].cast(t).alias(c) if c in new else F.col(f"row.`{c}`").alias(c) for c, t in docs.dtypes])
