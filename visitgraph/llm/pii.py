"""Personal data by candidate gradient boosting, in DataFrame functions only."""

from __future__ import annotations

import re

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitgraph.llm.common import SPAN, apart, bound, clear_of, durable, join_spans, matches, spans_of, spent

KINDS = ["email", "ip", "card", "phone"]
# The same matches as the plain forms; possessive runs and look-behinds keep the search linear and off the stack.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
OCTET = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{0,2})"
#: High-recall generators: whatever looks a little like the kind. Their spans may overlap the base ones and each other.
GENERATORS = {
    "email": r"(?<![^\s<(\[\"',;:])[A-Za-z0-9._%+-]++(?:@|\x20?[(\[]at[)\]]\x20?)[A-Za-z0-9._-]{3,}+",
    "ip": r"(?<![0-9A-Za-z])[0-9]++(?:[.,:][0-9]++){3,}+",
    "card": r"(?<![0-9])[0-9](?:[\x20./-]{0,2}+[0-9]){10,}+(?![0-9])",
    "phone": r"(?<![0-9A-Za-z])(?:\+|00|\()?+[0-9](?:[\x20()./-]{0,2}+[0-9]){7,}+(?![0-9])",
}
CUES = {"email": "mail|contact|write|reach", "ip": "ip|host|addr|server", "card": "card|visa|amex|pay|credit", "phone": "tel|phone|call|fax|mobile"}
FEATURES = ["kind_no", "digits", "seps", "width", "first", "before", "after", "cue", "plus", "doubled", "zeros"]


def luhn(m: Column) -> Column:
    """12 to 19 digits that pass the Luhn sum."""
    d = F.reverse(F.regexp_replace(m, "[^0-9]", ""))
    doubled = F.translate(d, "0123456789", "0246813579")
    spots = F.sequence(F.lit(1), F.lit(19))
    total = F.aggregate(spots, F.lit(0), lambda acc, i: acc + F.coalesce(F.try_to_number(F.substr(F.when(i % 2 == 1, d).otherwise(doubled), i, F.lit(1)), F.lit("9")).cast("int"), F.lit(0)))
    return F.length(d).between(12, 19) & (total % 10 == 0)


def base_spans(text: Column) -> dict[str, Column]:
    """The base spans of each kind in ``text`` (not null)."""
    digits = F.length(text) > 0
    return {
        "email": spans_of(text, EMAIL, "email", lambda m: F.lit(True), F.contains(text, F.lit("@"))),
        "ip": spans_of(text, IP, "ip", lambda m: m.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$"), F.contains(text, F.lit("."))),
        "card": spans_of(text, CARD, "card", luhn, digits),
        "phone": spans_of(text, PHONE, "phone", lambda m: F.length(F.regexp_replace(m, "[^0-9]", "")).between(9, 15), F.contains(text, F.lit("+"))),
    }


def candidate_spans(text: Column) -> Column:
    """All generators' spans, struct(s, e, kind, m, b, a) with the text just before and after; they may overlap."""
    gates = {"email": text.rlike(r"@|[(\[]at[)\]]")}
    numeric = text.rlike("[0-9]")
    none = F.expr("cast(array() as array<struct<s:int,e:int,kind:string,m:string,b:string,a:string>>)")
    of = lambda kind, g: F.transform(matches(text, g), lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), F.lit(kind).alias("kind"), x["m"].alias("m"), x["b"].alias("b"), x["a"].alias("a")))
    return F.concat(*[F.when(gates.get(k, numeric), of(k, g)).otherwise(none) for k, g in GENERATORS.items()])


def features(x: Column) -> dict[str, Column]:
    """Small whole numbers describing format and context of candidate ``x``; the format checks themselves stay out."""
    m, before = x["m"], F.lower(x["b"])
    left, right = F.right(x["b"], F.lit(1)), x["a"]
    side = lambda c: F.when(c == "", 0).when(c.rlike(r"\s"), 1).when(c.rlike(r"[\p{L}\p{N}]"), 2).otherwise(3)
    cue = F.lit(False)
    for k, words in CUES.items():
        cue = cue | ((x["kind"] == k) & before.rlike(words))
    return {
        "kind_no": F.when(x["kind"] == "email", 0).when(x["kind"] == "ip", 1).when(x["kind"] == "card", 2).otherwise(3),
        "digits": F.least(F.length(F.regexp_replace(m, "[^0-9]", "")), F.lit(20)),
        "seps": F.least(F.length(F.regexp_replace(m, "[A-Za-z0-9]", "")), F.lit(6)),
        "width": F.least((F.length(m) / 4).cast("int"), F.lit(8)),
        "first": F.when(m.rlike("^[0-9]"), 0).when(m.rlike("^[A-Za-z]"), 1).otherwise(2),
        "before": side(left),
        "after": side(right),
        "cue": cue.cast("int"),
        "plus": m.startswith("+").cast("int"),
        "doubled": m.rlike(r"[^0-9A-Za-z]{2}").cast("int"),
        "zeros": m.startswith("00").cast("int"),
    }


def well_formed(x: Column) -> Column:
    """Whether span ``x`` is personal data of its kind once written plainly: [at] as @, separators out, then the checks of the kind.

    Only labels use this. IPs need one separator throughout and are no numbers grouped by thousands; phones need a
    plus, 00 or a bracketed area code, as digits alone may count anything.
    """
    m = x["m"]
    mail = F.regexp_replace(F.regexp_replace(m, r"\x20?[(\[]at[)\]]\x20?", "@"), "[._-]+$", "")
    quad = m.rlike(r"^[0-9]+([.,:])[0-9]+\1[0-9]+\1[0-9]+$") & ~m.rlike("^[0-9]{1,3}(?:,[0-9]{3})+$")
    dialled = F.regexp_replace(F.regexp_replace(m, "^00", ""), "[^0-9]", "")
    return (
        F.when(x["kind"] == "email", mail.rlike(r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+$"))
        .when(x["kind"] == "ip", quad & F.regexp_replace(m, "[,:]", ".").rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$"))
        .when(x["kind"] == "card", luhn(m))
        .otherwise(m.rlike(r"^(?:\+|00[1-9]|\([0-9]{2,5}\))") & F.length(dialled).between(9, 15))
    )


def _tree(lines: list[str]) -> tuple | float:
    """One tree of a model's debug text as nested (feature, limit, yes, no)."""
    line = lines.pop(0).strip()
    if line.startswith("Predict:"):
        return float(line.split()[1])
    no, at = re.match(r"If \(feature (\d+) <= ([-\d.E]+)\)", line).groups()
    yes = _tree(lines)
    lines.pop(0)
    return FEATURES[int(no)], float(at), yes, _tree(lines)


def margin(trees: list[tuple[float, tuple | float]], f: Column) -> Column:
    """The boosted sum over struct ``f`` of features, as CASE expressions."""

    def walk(node) -> Column:
        if isinstance(node, float):
            return F.lit(node)
        name, at, yes, no = node
        return F.when(f[name] <= at, walk(yes)).otherwise(walk(no))

    total = F.lit(0.0)
    for weight, node in trees:
        total = total + F.lit(weight) * walk(node)
    return total


def fit(docs: DataFrame, text_col: str = "text", rounds: int = 12, depth: int = 3, precision: float = 0.97, seed: int = 7) -> tuple[dict[str, list], dict[str, float]] | None:
    """Boosted trees over all candidates of ``docs``: (weighted trees by kind, threshold by kind).

    Each kind has trees of its own, as the same digits may be a card and no phone. A candidate counts as personal data
    if it is ``well_formed``. Every feature has a few whole values, so candidates are first counted by (features, label,
    overlap, fold), whatever the size of the corpus; trees are fitted with these counts as weights. Candidates of one
    text in five, by its hash, are held out of the fit: the threshold of a kind is the lowest margin (to two
    decimals) at which at least ``precision`` of the held-out candidates that could be added (those clear of base spans)
    are personal data; a kind without any adds nothing. None without both labels.
    """
    d = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("t")).where("t rlike '[0-9@]|[(\\\\[]at[)\\\\]]'")

    def judged(p: Column) -> Column:
        free = F.transform(clear_of(p["all"], p["base"]), lambda x: F.struct(x.alias("x"), F.lit(True).alias("free")))
        return F.concat(free, F.transform(F.array_except(p["all"], F.transform(free, lambda y: y["x"])), lambda x: F.struct(x.alias("x"), F.lit(False).alias("free"))))

    found = d.select((F.pmod(F.xxhash64("t"), F.lit(5)) == 0).alias("held"), F.explode(bound(F.struct(candidate_spans(F.col("t")).alias("all"), F.concat(*base_spans(F.col("t")).values()).alias("base")), judged)).alias("y"))
    x = F.col("y.x")
    counts = found.select(*[c.cast("int").alias(n) for n, c in features(x).items()], well_formed(x).cast("double").alias("label"), F.col("y.free").alias("free"), "held")
    counts = durable(counts.groupBy(*FEATURES, "label", "free", "held").agg(F.count("*").cast("double").alias("n")))
    both = {(r["kind_no"], r["label"]) for r in counts.where("NOT held").select("kind_no", "label").distinct().collect()}
    if len({label for _, label in both}) < 2:
        return None
    trees, cut = {}, {}
    for i, kind in enumerate(KINDS):
        mine, trees[kind] = counts.where(F.col("kind_no") == i), []
        if {(i, 0.0), (i, 1.0)} <= both:
            data = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(mine.where("NOT held").coalesce(1).sortWithinPartitions(*FEATURES, "label", "free"))
            model = GBTClassifier(labelCol="label", weightCol="n", maxIter=rounds, maxDepth=depth, maxBins=32, stepSize=0.3, seed=seed).fit(data)
            trees[kind] = [(w, _tree(t.toDebugString.splitlines()[1:])) for w, t in zip(model.treeWeights, model.trees, strict=True)]
        margins = F.floor(margin(trees[kind], F.struct(*FEATURES)) * 100).cast("long").alias("z")
        held = mine.where("held AND free").groupBy(margins).agg(F.sum(F.col("n") * F.col("label")).alias("good"), F.sum("n").alias("n"))
        good = total = 0.0
        for r in sorted(held.collect(), key=lambda r: -r["z"]):
            good, total = good + r["good"], total + r["n"]
            if good >= precision * total:
                cut[kind] = r["z"] / 100
    spent(counts)
    return trees, cut


def find_personal_data(docs: DataFrame, text_col: str = "text", model: tuple[dict[str, list], dict[str, float]] | None = None) -> DataFrame:
    """``docs`` with ``base`` and ``added``: arrays of struct(s, e, kind, m) of personal data in the whole text.

    ``base`` holds the fixed formats. ``added`` holds candidates whose boosted margin reaches their kind's threshold
    and that overlap no base span; where several overlap, the one that starts first (then the longest) stays.
    Null and empty texts give empty arrays; columns of ``docs`` named base or added are replaced, all others stay;
    repeated rows give repeated results; an empty table gives an empty one. Work is row by row, without a shuffle.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    nothing = F.expr(f"cast(array() as array<{SPAN}>)")
    # both columns come from the given text, even if that is called base or added
    base, added = F.concat(*base_spans(text).values()), nothing
    if model is not None and model[1]:
        trees, cut = model

        def taken(x: Column) -> Column:
            def reached(f: Column) -> Column:
                ok = F.lit(False)
                for k, v in cut.items():
                    ok = F.when(x["kind"] == k, margin(trees[k], f) >= v).otherwise(ok)
                return ok

            return bound(F.struct(*[c.cast("int").alias(n) for n, c in features(x).items()]), reached)

        def chosen(x: Column) -> Column:
            return F.when(F.size(x) > 0, apart(clear_of(x, base))).otherwise(nothing)

        added = F.when(text.rlike(r"[0-9@]|[(\[]at[)\]]"), bound(F.filter(candidate_spans(text), taken), chosen)).otherwise(nothing)
    return docs.withColumns({"base": base, "added": added})


def op1_pii(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = find_personal_data(docs, model=fit(docs))
    n = lambda k: F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select("doc_id", *[n(k) for k in KINDS], F.sha2(join_spans(F.col("base"), KINDS), 256).alias("base_sha256"), join_spans(F.concat("base", "added"), KINDS).alias("spans"), F.size("added").cast("long").alias("n_added"))
