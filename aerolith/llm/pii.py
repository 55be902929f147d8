"""Personal data by weak supervision, in DataFrame functions throughout.

Base spans (leftmost, non-overlapping per kind, failing matches dropped):
email, ip (parts at most 255), card (12 to 19 digits passing Luhn), phone (9
to 15 digits). They always stay. Looser patterns propose further candidates:
e-mail addresses with a written "at" and "dot", phone numbers without a plus
sign, card-like numbers that fail Luhn, account numbers, social security
numbers and credentials.

Labelers vote +, - or 0 (abstain) on every span, base or candidate:

* form:      the strict regex of the kind holds, or surely not
* checksum:  Luhn, part ranges, issued number blocks
* gazetteer: top-level domains, card issuer prefixes, calling codes, names of credentials
* context:   words just before the span that announce or contradict its kind
* edge:      the span stands free, or inside a longer token

Expectation maximisation (a latent class per span, each labeler with its own
vote probabilities per class) runs over the counts of vote patterns, a table
bounded by the number of kinds, votes and feature values, however many spans
there are. A logistic span classifier is then fitted to the posteriors over
votes and shape features, and decides on the candidates that are not base.

Matching is linear in the text: the e-mail local part and digit runs are only
tried at their start (or where the last match ended), and repeated groups are
possessive, which takes the same matches without backtracking.

Defined cases: null text is empty and has no spans; a null doc_id stays null;
repeated rows give repeated rows; without any span the classifier keeps none.
"""

from __future__ import annotations

import math
from collections import defaultdict
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolith.llm.common import fresh, table

# fixed values: the base patterns in equivalent linear form, in the order of the kinds
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])(?=(?:[0-9][\x20-]?){11}[0-9])[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KINDS = [*BASE, "account", "ssn", "secret"]
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?[\[(](?:at|AT)[\])]\x20?[A-Za-z0-9-]{1,63}\x20?[\[(](?:dot|DOT)[\])]\x20?[A-Za-z]{2,24}",
    "phone": r"(?<![0-9A-Za-z+().-])(?:\([0-9]{2,4}\)\x20?|[0-9]{2,4}[\x20.-])[0-9]{3,4}[\x20.-][0-9]{3,4}(?![0-9A-Za-z-])",
    "account": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ssn": r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
    "secret": r"(?i)(?<![a-z0-9])(?:token|secret|password|passwd|api[_-]?key)\x20{0,2}[=:]\x20{0,2}[\"']?[a-z0-9_+/-]{16,}+",
}
TOP_DOMAINS = "com org net edu gov int info biz io de fr es uk it nl eu us ca au ch at be pl se no dk fi pt br jp cn in ru"
POSITIVE = {
    "email": "mail|e-mail|email|contact|write|kontakt|contacto|adresse|courriel|correo",
    "ip": "ip|host|server|address|from|login|client|addr|peer",
    "card": "card|visa|mastercard|amex|credit|debit|karte|carte|tarjeta|payment|pay",
    "phone": "phone|tel|telephone|call|mobile|cell|fax|contact|telefon|téléphone|teléfono|ring|dial",
    "account": "iban|account|bank|konto|compte|cuenta|bic|transfer",
    "ssn": "ssn|social|security|insurance",
    "secret": "token|secret|password|key|credential|auth|login",
}
NEGATIVE = "order|invoice|version|isbn|issn|part|sku|serial|ref|page|section|figure|table|line|release|build|ticket"
VOTES = ["form", "checksum", "gazetteer", "context", "edge"]
CONTEXT_CHARS = 32
KEEP_AT = 0.5
BLOCK = 128
MATCH = "array<struct<at:int,stop:int,m:string,ctx:string,nxt:string>>"
EM_ROUNDS = 50


def _pieces(gaps: Column, ms: Column) -> Column:
    """Blocks of up to ``BLOCK`` (match, text before it, text after it)."""
    rows = F.slice(F.arrays_zip(ms.alias("m"), gaps.alias("gap"), F.slice(gaps, 2, 1 << 30).alias("after")), 1, F.size(ms))
    return F.struct(rows.alias("rows"), F.sequence(F.lit(0), F.floor((F.size(ms) - 1) / BLOCK).cast("int")).alias("at"))


def _blocks(pieces: Column) -> Column:
    return F.transform(pieces["at"], lambda k: F.slice(pieces["rows"], k * BLOCK + 1, BLOCK))


def _matches(blocks: Column) -> Column:
    """Matches as (at, stop, m, ctx, nxt) from the matches and the text between
    them: positions are running sums of their lengths, per block and within."""
    none = F.expr(f"CAST(array() AS {MATCH})")

    def step(acc, r):
        at = acc["at"] + F.length(r["gap"])
        one = F.struct(at.alias("at"), (at + F.length(r["m"])).alias("stop"), r["m"].alias("m"),
                       F.substring(r["gap"], -CONTEXT_CHARS, CONTEXT_CHARS).alias("ctx"),
                       F.substring(r["after"], 1, 1).alias("nxt"))
        return F.struct((at + F.length(r["m"])).alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))

    def size(block):
        return F.aggregate(block, F.lit(0), lambda n, r: n + F.length(r["gap"]) + F.length(r["m"]))

    def offsets(acc, n):
        return F.concat(acc, F.array(F.element_at(acc, -1) + n))
    begin = F.aggregate(F.transform(blocks, size), F.array(F.lit(0)), offsets)
    return F.flatten(F.zip_with(blocks, F.slice(begin, 1, F.size(blocks)), lambda block, at: F.aggregate(
        block, F.struct(at.alias("at"), none.alias("out")), step)["out"]))


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    marks = F.filter(F.split(F.reverse(digits), ""), lambda c: c != "")
    doubled = F.transform(marks, lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(
        c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + x) % 10 == 0


def _between(n: Column, low: int, high: int) -> Column:
    return (n >= low) & (n <= high)


def _valid(kind: str, m: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return F.forall(F.split(m, r"\."), lambda p: F.length(F.regexp_replace(p, "^0+", "")) < 4) & F.forall(
            F.split(m, r"\."), lambda p: F.coalesce(F.try_to_number(F.right(p, F.lit(3)), F.lit("999")), F.lit(0)) <= 255)
    if kind == "card":
        return _between(F.length(_digits(m)), 12, 19) & luhn(_digits(m))
    return _between(F.length(_digits(m)), 9, 15)


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, F.lit("+")).when(no, F.lit("-")).otherwise(F.lit("0"))


def _labelled(kind: str, base: bool, r: Column) -> Column:
    """A span with its votes and its shape features as two short strings."""
    m, ctx, nxt, digits = r["m"], F.lower(r["ctx"]), r["nxt"], _digits(r["m"])
    no, yes = F.lit(False), F.lit(True)
    form = _vote(yes, no) if base else _vote(F.lit(kind in ("account", "ssn", "secret")), no)
    checksum = {
        "ip": _vote(yes, no), "card": _vote(luhn(digits), yes),
        "phone": _vote(_between(F.length(digits), 10, 13), ~_between(F.length(digits), 7, 15)),
        "ssn": _vote(~m.rlike("^(000|666|9..)|-00-|-0000$"), yes),
        "account": _vote(_between(F.length(F.regexp_replace(m, " ", "")), 15, 34), yes),
        "secret": _vote(m.rlike("[0-9]") & m.rlike("[a-z].*[a-z]"), yes),
    }.get(kind, F.lit("0"))
    gazetteer = {
        "email": _vote(F.lower(F.regexp_extract(m, r"([A-Za-z]+)$", 1)).isin(TOP_DOMAINS.split()), no),
        "ip": _vote(~m.rlike(r"^(0|127|255)\."), yes),
        "card": _vote(digits.rlike("^(4|5[1-5]|2[2-7]|3[47]|6011|65|35)"), no),
        "phone": _vote(m.rlike(r"^\+(1|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|7|8[1246]|9[0-58])"), no),
        "account": _vote(m.rlike("^(DE|FR|ES|GB|IT|NL|BE|AT|CH|PT|PL|SE|DK|NO|FI|IE|LU)"), yes),
        "secret": _vote(yes, no),
    }.get(kind, F.lit("0"))
    context = _vote(ctx.rlike(rf"(^|[^a-z])({POSITIVE[kind]})[^a-z0-9]{{0,6}}([a-z]{{1,4}}[^a-z0-9]{{1,3}})?$"),
                    ctx.rlike(rf"(^|[^a-z])({NEGATIVE})[^a-z0-9]{{0,6}}(no|nr|number)?[^a-z0-9]{{0,4}}$"))
    edge = _vote(~F.lower(F.right(ctx, F.lit(1))).rlike("[a-z0-9_]") & ~nxt.rlike("[A-Za-z0-9_]"), yes)
    length = F.least(F.floor(F.length(m) / 8), F.lit(6)).cast("string")
    share = F.floor(F.length(digits) * 4 / F.length(m)).cast("string")
    after = F.when(nxt == "", "e").when(nxt.rlike(r"\s"), "s").when(nxt.rlike("[.,;:!?]"), "p").otherwise("o")
    return F.struct(r["at"].alias("at"), F.lit(KINDS.index(kind)).alias("kind"), r["stop"].alias("stop"),
                    F.lit(base).alias("base"), F.concat(form, checksum, gazetteer, context, edge).alias("votes"),
                    F.concat(length, share, after).alias("shape"))


def _holds(kind: str, r: Column) -> Column:
    return _valid(kind, r["m"])


def with_candidates(docs: DataFrame, out: str, text: str = "text") -> DataFrame:
    """``docs`` and an array ``out`` of all labelled spans, sorted by start and kind."""
    columns = docs.columns
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    has_digit = whole.rlike("[0-9]")
    tests = {"email": whole.contains("@"), "phone": whole.contains("+")}
    at = [whole.contains(x) for x in ("(at)", "[at]", "(AT)", "[AT]")]
    loose_tests = {"email": at[0] | at[1] | at[2] | at[3], "secret": whole.contains("=") | whole.contains(":")}
    none = F.expr("CAST(array() AS array<string>)")
    ms, gaps, parts, blocks, found, names = {}, {}, {}, {}, {}, []
    for part, patterns, conditions in (("b", BASE, tests), ("l", LOOSE, loose_tests)):
        for kind, pattern in patterns.items():
            m, g, p, k, f = (fresh(columns, f"__{part}{x}_{kind}") for x in "mgpkf")
            names.append((part == "b", kind, f))
            ms[m] = F.when(conditions.get(kind, has_digit), F.regexp_extract_all(whole, F.lit(pattern), F.lit(0))).otherwise(none)
            gaps[g] = F.when(F.size(m) > 0, F.split(whole, pattern, -1)).otherwise(none)
            parts[p] = F.when(F.size(m) > 0, _pieces(F.col(g), F.col(m)))
            blocks[k] = F.when(F.size(m) > 0, _blocks(F.col(p)))
            found[f] = F.when(F.size(m) > 0, _matches(F.col(k))).otherwise(F.expr(f"CAST(array() AS {MATCH})"))
    raw = docs.withColumns(ms).withColumns(gaps).withColumns(parts).withColumns(blocks).withColumns(found)
    base, loose = [], []
    for is_base, kind, f in names:
        good = F.filter(f, partial(_holds, kind)) if is_base else F.col(f)
        (base if is_base else loose).append(F.transform(good, partial(_labelled, kind, is_base)))
        if is_base and kind == "card":  # numbers of a card's length that fail Luhn are candidates
            failed = F.filter(f, lambda r: _between(F.length(_digits(r["m"])), 13, 19) & ~luhn(_digits(r["m"])))
            loose.append(F.transform(failed, partial(_labelled, kind, False)))
    b, c = fresh(columns, "__base"), fresh(columns, "__loose")
    # a candidate that meets a base span is that span, seen loosely
    free = F.filter(F.col(c), lambda x: ~F.exists(F.col(b), lambda y: (x["at"] < y["stop"]) & (y["at"] < x["stop"])))
    return (raw.withColumns({b: F.concat(*base), c: F.concat(*loose)})
            .select(*[F.col(f"`{x}`") for x in columns], F.array_sort(F.concat(F.col(b), free)).alias(out)))


def expectation_maximisation(counts: dict[tuple[int, str], float], rounds: int = EM_ROUNDS) -> dict[tuple[int, str], float]:
    """Posterior that a span of (kind, votes) is personal data. Labelers keep one
    table of vote probabilities per class over all kinds; kinds keep their own
    share of true spans. Begins from the votes' majority."""
    post = {(k, v): 1 / (1 + math.exp(-(v.count("+") - 2.0 * v.count("-")))) for k, v in counts}
    for _ in range(rounds):
        share, table_ = {}, [{y: defaultdict(lambda: 1.0) for y in (0, 1)} for _ in VOTES]
        mass, true = defaultdict(lambda: 2.0), defaultdict(lambda: 1.0)
        for (k, v), n in counts.items():
            p = post[k, v]
            mass[k] += n
            true[k] += n * p
            for j, c in enumerate(v):
                table_[j][1][c] += n * p
                table_[j][0][c] += n * (1 - p)
        total = [{y: sum(t[y][c] for c in "+-0") for y in (0, 1)} for t in table_]
        share = {k: true[k] / mass[k] for k in mass}
        moved = 0.0
        for k, v in counts:
            z = math.log(share[k] / (1 - share[k]))
            for j, c in enumerate(v):
                z += math.log(table_[j][1][c] / total[j][1]) - math.log(table_[j][0][c] / total[j][0])
            p = 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))
            moved = max(moved, abs(p - post[k, v]))
            post[k, v] = p
        if moved < 1e-6:
            break
    return post


def _features(kind: int, votes: str, shape: str) -> list[str]:
    return [f"k{kind}", *(f"v{j}{c}" for j, c in enumerate(votes)), *(f"s{j}{c}" for j, c in enumerate(shape))]


def fit(rows: list[tuple[int, str, str, int]], epochs: int = 200, rate: float = 0.5, l2: float = 1e-3) -> dict[str, float]:
    """Weights of the span classifier from (kind, votes, shape, count) rows."""
    counts: dict[tuple[int, str], float] = defaultdict(float)
    for k, v, _, n in rows:
        counts[k, v] += n
    post = expectation_maximisation(counts)
    data = [(_features(k, v, s), post[k, v], math.log1p(n)) for k, v, s, n in rows]
    whole = sum(n for _, _, n in data) or 1.0
    w: dict[str, float] = defaultdict(float)
    for _ in range(epochs):
        g: dict[str, float] = defaultdict(float)
        for names, p, n in data:
            d = (1 / (1 + math.exp(-max(-30.0, min(30.0, sum(w[x] for x in names) + w["bias"])))) - p) * n / whole
            for x in (*names, "bias"):
                g[x] += d
        for x, d in g.items():
            w[x] -= rate * (d + l2 * w[x])
    return dict(w)


def trained(labelled: DataFrame, spans: str) -> dict[str, float]:
    """The span classifier, from the pattern counts of all spans of all documents."""
    # the table of patterns is bounded by 7 kinds, 3^5 votes and 7 * 5 * 4 shapes, whatever the input
    # the outer form: for explode Spark infers a filter on the array's size, which computes all spans twice
    found = labelled.select(F.explode_outer(spans).alias("s")).where("s is not null").select("s.*")
    found = found.groupBy("kind", "votes", "shape").count().collect()
    return fit(sorted((r.kind, r.votes, r.shape, r["count"]) for r in found))


def _kept(x: Column, weights: dict[str, float]) -> Column:
    z = F.lit(weights.get("bias", 0.0))

    def part(value: Column, prefix: str, values) -> Column:
        known = [(v, weights[f"{prefix}{v}"]) for v in values if f"{prefix}{v}" in weights]
        out = F.lit(-1.0)  # a value never seen in training
        for v, weight in known:
            out = F.when(value == v, F.lit(weight)).otherwise(out)
        return out
    z = z + part(x["kind"].cast("string"), "k", [str(k) for k in range(len(KINDS))])
    for j in range(len(VOTES)):
        z = z + part(F.substring(x["votes"], j + 1, 1), f"v{j}", "+-0")
    for j, values in enumerate(("0123456", "01234", "espo")):
        z = z + part(F.substring(x["shape"], j + 1, 1), f"s{j}", values)
    return x["base"] | (z >= F.lit(math.log(KEEP_AT / (1 - KEEP_AT))))


def _joined(spans: Column) -> Column:
    name = F.array(*[F.lit(k) for k in KINDS])
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(name, s["kind"] + 1), s["at"].cast("string"), s["stop"].cast("string"))))


def spans_of(docs: DataFrame, out: str) -> DataFrame:
    """``docs`` with an array ``out`` of the spans that stay."""
    labelled = with_candidates(docs, out)
    weights = trained(labelled, out)
    return labelled.withColumn(out, F.filter(F.col(out), lambda x: _kept(x, weights)))


def _of_kind(kind: int, s: Column) -> Column:
    return s["kind"] == kind


def find(docs: DataFrame) -> DataFrame:
    """doc_id, counts of base spans per kind, base_sha256, spans of every row."""
    found = spans_of(docs.select("doc_id", "text"), "s").drop("text")
    base = found.withColumn("b", F.filter("s", lambda x: x["base"]))
    counts = [F.size(F.filter("b", partial(_of_kind, i))).cast("long").alias(f"n_{k}") for i, k in enumerate(BASE)]
    return base.select("doc_id", *counts, F.sha2(_joined(F.col("b")), 256).alias("base_sha256"), _joined(F.col("s")).alias("spans"))


def redacted(docs: DataFrame) -> DataFrame:
    """``docs`` with every span replaced by the name of its kind in angle
    brackets (overlapping spans by one) and n_chars to match; rows without
    spans are unchanged."""
    columns = docs.columns
    s, merged = fresh(columns, "__spans"), fresh(columns, "__merged")
    none = F.expr("CAST(array() AS array<struct<at:int,stop:int,kind:int>>)")

    def join(acc, x):
        last = F.element_at(acc, -1)
        meets = (F.size(acc) > 0) & (x["at"] < F.when(F.size(acc) > 0, last["stop"]).otherwise(0))
        one = F.struct(x["at"].alias("at"), x["stop"].alias("stop"), x["kind"].alias("kind"))
        wider = F.struct(last["at"].alias("at"), F.greatest(last["stop"], x["stop"]).alias("stop"), last["kind"].alias("kind"))
        return F.when(meets, F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), F.array(wider))).otherwise(
            F.concat(acc, F.array(one)))
    found = spans_of(docs, s).withColumn(
        merged, F.when(F.size(s) > 0, F.aggregate(F.col(s), none, join)).otherwise(none))
    name = F.array(*[F.lit(f"<{k.upper()}>") for k in KINDS])
    text, m = F.col("text"), F.col(merged)
    pieces = F.transform(m, lambda x, i: F.concat(
        F.substring(text, F.when(i > 0, F.get(m, i - 1)["stop"]).otherwise(0) + 1,
                    x["at"] - F.when(i > 0, F.get(m, i - 1)["stop"]).otherwise(0)),
        F.element_at(name, x["kind"] + 1)))
    tail = F.substring(text, F.element_at(m, -1)["stop"] + 1, F.length(text))
    found = found.withColumn("text", F.when(F.size(m) > 0, F.concat(F.array_join(pieces, ""), tail)).otherwise(text))
    if "n_chars" in columns:
        found = found.withColumn("n_chars", F.when(F.size(m) > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return found.select(*[F.col(f"`{c}`") for c in columns])


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find(table(spark, sf_dir, "documents"))
