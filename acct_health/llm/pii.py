"""Personal data by rules and weak supervision (operator 8), in DataFrame expressions only.

Base spans come from four fixed patterns with their checks and always stay. Their expressions
below are the stated ones with possessive repeats and with a start condition where a
failed run would be tried again from each of its characters: the same matches in linear time and
without recursion. The places of matches are running sums of the lengths of what ``split`` finds
between them and of the matches themselves.

Further spans are candidates of looser patterns. Four labelers vote on each (for, against or
abstaining): a strict pattern, a gazetteer, the words before it, and the variety of its
characters. Expectation-maximisation over the counts of vote patterns in the whole corpus
estimates, for each kind, how often a labeler votes how for true and for false candidates;
that turns a vote pattern into a probability. With these as soft labels a naive Bayes classifier
over features of the span itself (length, shape, neighbours, votes) is trained on all
candidates, and the candidates that it gives more than ``THRESHOLD`` are added.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acct_health.llm.common import read_table, written

# The kinds in the order they are listed, and their patterns.
LOCAL = "[A-Za-z0-9._%+-]"
BASE = {
    "email": rf"(?:(?<!{LOCAL})|\G){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9]){12,}+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
NEEDS = {"email": "@", "phone": "+"}  # texts without this have no match
ADDED = {
    "masked_email": rf"(?<!{LOCAL}){LOCAL}{{1,64}}+ ?[(\[]at[)\]] ?[A-Za-z0-9-]{{1,63}}+ ?[(\[]dot[)\]] ?[A-Za-z]{{2,12}}+",
    "local_phone": r"(?<![0-9+(])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "person": r"(?<![A-Za-z])[A-Z][a-z]{1,20}+ [A-Z][a-z]{1,20}+(?![A-Za-z])",
    "secret": r"(?<![A-Za-z0-9])[A-Fa-f0-9]{32,128}+(?![A-Za-z0-9])",
}
STRICT = {
    "masked_email": r"(?i)(com|org|net|edu|gov|io|de|fr|es)$",
    "local_phone": r"^(\([2-9][0-9]{2}\) [2-9][0-9]{2}-[0-9]{4}|[2-9][0-9]{2}([.-])[2-9][0-9]{2}\2[0-9]{4})$",
    "ssn": r"^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}$",
    "person": r"^[A-Z][a-z]{2,} [A-Z][a-z]{2,}$",
    "secret": r"^(?=.*[0-9])(?=.*[A-Fa-f])",
}
CUES = {
    "masked_email": r"(?i)\b(e-?mail|contact|write|reach|mail)\b",
    "local_phone": r"(?i)\b(phone|tel|call|mobile|cell|fax|contact)\b",
    "ssn": r"(?i)\b(ssn|social security|tax id)\b",
    "person": r"(?i)\b(name is|named|mr|mrs|ms|dr|contact|dear|signed|author|by)\b[.:]? ?$",
    "secret": r"(?i)\b(token|secret|password|passwd|api[_ -]?key|key)\b",
}
TITLE = r"\b(Mr|Mrs|Ms|Dr|Prof)\.? $"
AGAINST = r"(?i)\b(order|invoice|isbn|issn|version|part no|serial|commit|checksum|md5|sha1|sha256)\b"
FIRST_NAMES = ("alice anna bob carlos carol charles daniel david elena emma eva george hans ines james jean john jose juan julia "
               "karl laura linda lucia luis maria marie mark martin mary michael paul peter pierre robert sarah sofia susan "
               "thomas william").split()
DUMMIES = ("123-45-6789", "078-05-1120", "555-555-5555", "d41d8cd98f00b204e9800998ecf8427e")

LOCATED = "array<struct<start:int,end:int,match:string,before:string,after:string>>"
BLOCK = 128  # matches in one fold
CONTEXT = 40  # characters before a candidate that the context labeler reads
THRESHOLD = 0.5
ROUNDS = 25  # of expectation-maximisation
BLOT = "\u0001"
VALUES = 64  # of each feature of the classifier
LABELERS = 4
FEATURES = 4 + LABELERS
AGAINST_VOTE, ABSTAIN, FOR_VOTE = 0, 1, 2


def let(value: Column, body) -> Column:
    """``body(value)``, with ``value`` computed once however often ``body`` names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _blocks(items: Column) -> Column:
    """An array cut into arrays of up to ``BLOCK`` items, so that folds that append stay short."""
    return F.transform(F.sequence(F.lit(0), F.floor((F.size(items) - 1) / BLOCK).cast("int")),
                       lambda b: F.slice(items, b * BLOCK + 1, F.lit(BLOCK)))


def located(text: Column, pattern: str) -> Column:
    """array<struct<start, end, match, before, after>> of the leftmost non-overlapping matches, in code points; before
    and after: up to ``CONTEXT`` characters since the last match, and the one that follows."""
    none = F.array().cast(LOCATED)

    def step(acc, x):
        start = acc["at"] + F.length(x["gap"])
        end = start + F.length(x["match"])
        before = F.when(F.length(x["gap"]) > CONTEXT, F.substring(x["gap"], -CONTEXT, CONTEXT)).otherwise(x["gap"])
        span = F.struct(start.alias("start"), end.alias("end"), x["match"].alias("match"), before.alias("before"),
                        F.substring(x["next"], 1, 1).alias("after"))
        return F.struct(end.alias("at"), F.concat(acc["spans"], F.array(span)).alias("spans"))

    def fold(block):
        return F.aggregate(block, F.struct(F.lit(0).alias("at"), none.alias("spans")), step)

    def ahead(inner):
        count = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("list"))
        return F.aggregate(inner, count, lambda a, x: F.struct((a["at"] + x["at"]).alias("at"),
                                                               F.concat(a["list"], F.array(a["at"])).alias("list")))["list"]

    def shifted(spans, by):
        return F.transform(spans, lambda s: F.struct((s["start"] + by).alias("start"), (s["end"] + by).alias("end"),
                                                     s["match"], s["before"], s["after"]))

    def placed(x):
        pairs = F.arrays_zip(x["m"].alias("match"), F.slice(x["g"], F.lit(1), F.size(x["m"])).alias("gap"),
                             F.slice(x["g"], F.lit(2), F.size(x["m"])).alias("next"))
        folded = let(pairs, lambda p: F.transform(_blocks(p), fold))
        return let(folded, lambda inner: let(ahead(inner), lambda offs: F.flatten(
            F.transform(inner, lambda b, i: shifted(b["spans"], offs[i])))))

    found = F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"), F.split(text, pattern, -1).alias("g"))
    return F.when(F.regexp_like(text, F.lit(pattern)), let(found, placed).cast(LOCATED)).otherwise(none)


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(match: Column) -> Column:
    """Whether the digits of ``match`` pass the Luhn check."""
    digits = F.reverse(F.split(_digits(match), ""))  # the last first

    def worth(d, i):
        n = d.cast("int")
        twice = F.when(n > 4, 2 * n - 9).otherwise(2 * n)
        return F.when(i % 2 == 1, twice).otherwise(n)

    each = F.transform(F.filter(digits, lambda d: d != ""), worth)
    return F.aggregate(each, F.lit(0), lambda a, x: a + x) % 10 == 0


def _valid(kind: str, span: Column) -> Column:
    match = span["match"]
    if kind == "ip":
        parts = F.transform(F.split(match, r"\."), lambda p: F.ltrim(p, F.lit("0")))
        return F.forall(parts, lambda p: (F.length(p) <= 3) & (F.coalesce(p.try_cast("int"), F.lit(0)) <= 255))
    if kind == "card":
        n = F.length(_digits(match))
        # the check is for bounded numbers of digits only
        return F.when((n >= 13) & (n <= 19), luhn(match)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(_digits(match)).between(9, 15)
    return F.lit(True)


def with_base(docs: DataFrame, text: str, out: str) -> DataFrame:
    """``docs`` with ``out``: array<struct<kind, start, end>> of the base spans, kinds as listed, then by start."""
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.withColumns({f"{out}_{k}": F.when(body.contains(NEEDS[k]), located(body, p)).otherwise(F.array().cast(LOCATED)) if k in NEEDS else located(body, p) for k, p in BASE.items()})

    def valid(k):
        good = F.filter(F.col(f"{out}_{k}"), lambda s: _valid(k, s))
        return F.transform(good, lambda s: F.struct(F.lit(k).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))

    return rows.withColumn(out, F.concat(*[valid(k) for k in BASE])).drop(*[f"{out}_{k}" for k in BASE])


def _votes(kind: str, match: Column, before: Column) -> list[Column]:
    vote = lambda yes, no: F.when(yes, FOR_VOTE).when(no, AGAINST_VOTE).otherwise(ABSTAIN)
    never = F.lit(False)
    strict = F.regexp_like(match, F.lit(STRICT[kind]))
    context = vote(F.regexp_like(before, F.lit(CUES[kind])), F.regexp_like(before, F.lit(AGAINST)))
    if kind == "person":
        # two capitalised words are no evidence of a person by themselves: a known first name or a title is
        known = F.lower(F.substring_index(match, " ", 1)).isin(FIRST_NAMES)
        return [vote(F.regexp_like(before, F.lit(TITLE)), ~strict), vote(known, ~known), context, F.lit(ABSTAIN)]
    gazetteer = vote(never, F.lower(match).isin(*DUMMIES))
    different = F.size(F.array_distinct(F.split(match, "")))
    return [vote(strict, ~strict), gazetteer, context, vote(different >= 8, different <= 4)]


def _bucket(value: Column) -> Column:
    return F.pmod(F.xxhash64(value), F.lit(VALUES)).cast("int")


def with_candidates(docs: DataFrame, text: str, base: str, out: str) -> DataFrame:
    """``docs`` with ``out``: array<struct<kind, start, end, votes, features>> of the candidates that touch no base span."""
    # base spans are blotted out, so nothing found touches one, and places stay
    rows = docs.withColumn(f"{out}_text", _rewritten(F.coalesce(F.col(text), F.lit("")), F.col(base), blotted=True))
    rows = rows.withColumns({f"{out}_{k}": located(F.col(f"{out}_text"), p) for k, p in ADDED.items()})

    def described(k):
        def one(s):
            shape = F.regexp_replace(F.regexp_replace(F.regexp_replace(s["match"], "[0-9]+", "9"), "[A-Z]+", "A"), "[a-z]+", "a")
            votes = _votes(k, s["match"], s["before"])
            features = [F.least(s["end"] - s["start"], F.lit(VALUES - 1)), _bucket(shape), _bucket(F.substring(s["before"], -1, 1)),
                        _bucket(s["after"]), *votes]
            return F.struct(F.lit(k).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), F.array(*votes).alias("votes"),
                            F.array(*[f.cast("int") for f in features]).alias("features"))

        return F.transform(F.col(f"{out}_{k}"), one)

    return rows.withColumn(out, F.concat(*[described(k) for k in ADDED])).drop(f"{out}_text", *[f"{out}_{k}" for k in ADDED])


def reliabilities(patterns: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(kind, theta) from (kind, votes, n). theta[0] is the share of true candidates; theta[1 + 6 j + 2 v + y] how often
    labeler j votes v for candidates of truth y. One row of at most 81 vote patterns per kind, and array functions on it."""
    rows = patterns.groupBy("kind").agg(F.collect_list(F.struct("votes", F.col("n").cast("double").alias("n"))).alias("p"))
    start = [0.5] + [x for _ in range(LABELERS) for x in (0.7, 0.1, 0.2, 0.2, 0.1, 0.7)]

    def voted(q, j, v, y):
        share = lambda x: x["n"] * (x["q"] if y else 1 - x["q"])
        return F.aggregate(q, F.lit(0.0), lambda a, x: a + F.when(x["votes"][j] == v, share(x)).otherwise(0.0))

    def update(q):
        total = F.aggregate(q, F.lit(0.0), lambda a, x: a + x["n"])
        true = F.aggregate(q, F.lit(0.0), lambda a, x: a + x["n"] * x["q"])

        def shares(sums):
            every = [(voted(q, j, v, y) + 1) / (sums[y] + 3) for j in range(LABELERS) for v in range(3) for y in range(2)]
            return F.array((sums[1] + 1) / (sums[0] + sums[1] + 2), *every)

        return let(F.array(total - true, true), shares)

    def step(theta, _):
        return let(F.transform("p", lambda x: F.struct(x["votes"].alias("votes"), x["n"].alias("n"),
                                                       truth(theta, x["votes"]).alias("q"))), update)

    theta = F.array(*[F.lit(x) for x in start])
    out = rows.withColumn("theta", theta)
    # the rounds are one loop over the row's own array
    return out.select("kind", F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), F.col("theta"), step).alias("theta"))


def truth(theta: Column, votes: Column) -> Column:
    """The probability that a candidate with these votes is true."""
    def likely(y):
        each = [theta[F.lit(1 + 6 * j + y) + 2 * votes[j]] for j in range(LABELERS)]
        return reduce(lambda a, b: a * b, each, theta[0] if y else 1 - theta[0])

    return likely(1) / (likely(0) + likely(1))


def train(docs: DataFrame, text: str = "text") -> list[float]:
    """The classifier's weights from all candidates of ``docs``: per kind a prior and, per feature and value, a log odds
    ratio. Counts are made by Spark; what comes to the driver is bounded by kinds x features x values."""
    found = with_candidates(with_base(docs.select(F.col(text).alias("text")), "text", "__base"), "text", "__base", "__found")
    # explode_outer: explode would have a filter on all these expressions pushed below them, so they'd run more than once
    each = found.select(F.explode_outer("__found").alias("c")).where("c IS NOT NULL").select("c.kind", "c.votes", "c.features")
    # vote patterns and features are counted together: candidates enter one small shuffle, combined before it
    counted = written(each.groupBy("kind", "votes", "features").agg(F.count(F.lit(1)).alias("n")), "candidates")
    theta = reliabilities(counted.groupBy("kind", "votes").agg(F.sum("n").alias("n")))
    soft = counted.join(theta, "kind").withColumn("q", truth(F.col("theta"), F.col("votes")))
    cells = soft.select("kind", "n", "q", F.posexplode("features").alias("feature", "value")).groupBy("kind", "feature", "value").agg(
        F.sum(F.col("n") * F.col("q")).alias("yes"), F.sum(F.col("n") * (1 - F.col("q"))).alias("no")).collect()
    return weights([(r["kind"], r["feature"], r["value"], r["yes"], r["no"]) for r in cells])


def weights(cells: list[tuple[str, int, int, float, float]]) -> list[float]:
    out = []
    for kind in ADDED:
        mine = [c for c in cells if c[0] == kind]
        yes, no = (sum(c[k] for c in mine if c[1] == 0) for k in (3, 4))
        out.append(math.log((yes + 1) / (no + 1)) if mine else -100.0)
        table = {(c[1], c[2]): (c[3], c[4]) for c in mine}
        for f in range(FEATURES):
            for v in range(VALUES):
                y, n = table.get((f, v), (0.0, 0.0))
                out.append(math.log((y + 1) / (yes + VALUES)) - math.log((n + 1) / (no + VALUES)) if mine else 0.0)
    return out


def with_spans(docs: DataFrame, model: list[float], text: str = "text", base: str = "base_spans", out: str = "spans") -> DataFrame:
    """``docs`` with the base spans and with all spans, arrays of struct<kind, start, end> in listed order of kinds, then by start;
    columns that have these names already are replaced.

    Null and empty texts have none. Spans of different kinds may overlap among base spans; an added one touches
    none of them. Equal texts get equal spans. An empty table stays empty.
    """
    width = 1 + FEATURES * VALUES
    # one text literal, folded into one array: an array of literals would be thousands of expressions
    table = F.split(F.lit(",".join(map(repr, model))), ",").cast("array<double>")
    rows = with_candidates(with_base(docs.drop(base, out), text, base), text, base, "__found")

    def chosen(k, i):
        def score(c):
            terms = [table[F.lit(i * width + 1 + f * VALUES) + c["features"][f]] for f in range(FEATURES)]
            return reduce(lambda a, b: a + b, terms, F.lit(float(model[i * width])))

        mine = F.filter(F.col("__found"), lambda c: (c["kind"] == k) & (1 / (1 + F.exp(-score(c))) > THRESHOLD))
        return F.transform(mine, lambda c: F.struct(c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end")))

    return rows.withColumn(out, F.concat(F.col(base), *[chosen(k, i) for i, k in enumerate(ADDED)])).drop("__found")


def told(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def _rewritten(text: Column, spans: Column, blotted: bool = False) -> Column:
    """``text`` with each span replaced: by ``[KIND]`` (of overlapping spans the one that begins first names the place),
    or blotted out, character by character."""
    def piece(acc, s):
        if blotted:
            return F.repeat(F.lit(BLOT), F.greatest(s["end"] - F.greatest(s["start"], acc["at"]), F.lit(0)))
        return F.when(s["start"] >= acc["at"], F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))).otherwise("")

    def block(items, begin, end):
        def told_from(part):
            def step(acc, s):
                gap = F.substring(part, acc["at"] - begin + 1, F.greatest(s["start"] - acc["at"], F.lit(0)))
                return F.struct(F.greatest(s["end"], acc["at"]).alias("at"), F.concat(acc["parts"], F.array(gap, piece(acc, s))).alias("parts"))

            first = F.struct(begin.alias("at"), F.array().cast("array<string>").alias("parts"))
            return F.array_join(F.aggregate(items, first, step)["parts"], "")

        return let(F.substring(text, begin + 1, end - begin), told_from)

    def reach(blocks):
        first = F.struct(F.lit(0).alias("at"), F.array(F.lit(0)).alias("list"))

        def step(acc, x):
            return let(F.greatest(acc["at"], F.array_max(F.transform(x, lambda s: s["end"]))), lambda m: F.struct(
                m.alias("at"), F.concat(acc["list"], F.array(m)).alias("list")))

        return F.aggregate(blocks, first, step)["list"]

    def whole(blocks):
        return let(reach(blocks), lambda r: F.concat(
            F.array_join(F.transform(blocks, lambda x, i: block(x, r[i], r[i + 1])), ""),
            F.substring(text, F.element_at(r, -1) + 1, F.length(text))))

    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    return F.when(F.size(spans) > 0, let(ordered, lambda o: let(_blocks(o), whole))).otherwise(text)


def masked(text: Column, spans: Column) -> Column:
    """``text`` with ``[KIND]`` for each span; of overlapping spans the one that begins first names the place."""
    return _rewritten(text, spans)


def mask_documents(docs: DataFrame, text: str = "text", chars: str = "n_chars") -> DataFrame:
    """``docs`` with the personal data in their texts replaced by ``[KIND]``, and ``chars`` of changed texts counted anew."""
    rows = with_spans(docs, train(docs, text), text, "__base_spans", "__spans")
    new = masked(F.col(text), F.col("__spans"))
    rows = rows.withColumn("__new", new)
    if chars in docs.columns:
        rows = rows.withColumn(chars, F.when(F.size("__spans") > 0, F.length("__new").cast(docs.schema[chars].dataType)).otherwise(F.col(chars)))
    return rows.withColumn(text, F.col("__new")).select(*docs.columns)


def op8_pii(spark, sf_dir: str) -> DataFrame:
    """All documents."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = with_spans(docs, train(docs))
    count = lambda k: F.size(F.filter("base_spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return rows.select("doc_id", *[count(k) for k in BASE], F.sha2(told(F.col("base_spans")), 256).alias("base_sha256"),
                       told(F.col("spans")).alias("spans"))
