"""Personal data: candidate spans, boosted trees over format and context, calibrated thresholds.

High-recall generators (patterns) propose spans, which may overlap. Those that
pass an exact rule (the base kinds: email, ip, card, phone) always stay. The
others are scored by boosted trees over features of their format and of the
text around them, and those whose score reaches a calibrated threshold are
added, unless a base span covers them.

The trees learn from weak labels of every candidate of all documents: one
counts as personal when it passes a base rule, or by its form and the words
before it (LABELS). Candidates that a base span covers take no part. Those of
three documents in four train the trees; candidates of equal features are one
row with their number as its weight. The threshold is the lowest score at which
the other documents' candidates that need it, those of no base rule, are right
often enough; scores are counted in steps, and candidates of one step pass or
fail together. Where there is only one class nothing is added.

All of it is DataFrame and SQL functions: matches and the text between them
come from one pattern, and positions are sums of their lengths, so nothing is
exploded or shuffled but the training's counts. No pattern crosses a line break, and all repeat
possessively, so a match takes time in proportion to its length.

Defined results: a null or empty text has no spans; rows with a null id keep
it; repeated rows each get their row; an empty table gives no rows; other
columns are ignored. Positions are code points, ends exclusive.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierwise.llm.trees import Boosted, train

#: Base kinds in their listed order. The look-behinds keep a search from
#: starting inside a run where it has failed already.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Kinds that only the trees can accept, listed after the base kinds.
EXTRA = {
    "secret": r"(?<![A-Za-z0-9_])[A-Za-z0-9_]{16,}+",
    "local_phone": r"\([0-9]{2,5}\)[\x20.-]?[0-9]{2,5}(?:[\x20.-][0-9]{2,5}){0,3}+",
    "masked_email": r"[A-Za-z0-9._%+-]{1,64}+ ?[\[(]at[\])] ?[A-Za-z0-9-]{1,63}+"
                    r"(?: ?(?:\.|[\[(]dot[\])]) ?[A-Za-z0-9-]{1,63}+){1,5}+",
}
KINDS = [*BASE, *EXTRA]
#: What a text must hold for a kind's pattern to be tried at all.
NEEDS = {"email": "text like '%@%'", "masked_email": r"text rlike '[\\[(]at[\\])]'"}
DIGIT = "text rlike '[0-9]'"

#: Least share of right candidates above the threshold in the held-out part.
PRECISION = 0.95
#: Steps of a score of 1 at which held-out candidates are counted, which bounds the counts by the
#: range of scores (a few units), however many candidates there are.
SCORE_STEPS = 1024
CONTEXT = 24
_BLOCK = 256

FEATURES = {
    "kind_no": "double(array_position(array({kinds}), c.kind))",
    "chars": "double(char_length(c.m))",
    "digits": "double(char_length(regexp_replace(c.m, '[^0-9]', '')))",
    "letters": "double(char_length(regexp_replace(c.m, '[^A-Za-z]', '')))",
    "capitals": "double(char_length(regexp_replace(c.m, '[^A-Z]', '')))",
    "groups": "double(size(split(c.m, '[^0-9A-Za-z]+')))",
    "changes": "double(size(regexp_extract_all(c.m, '[0-9][A-Za-z]|[A-Za-z][0-9]', 0)))",
    "variety": "double(size(array_distinct(split(c.m, ''))))",
    "hexadecimal": "double(c.m rlike '^[0-9a-fA-F]+$')",
    "checksum": "double({luhn})",
    "octets": "double({octets})",
    "domain": r"double(c.m rlike '([.]|[(\\[]dot[)\\]]) ?[A-Za-z]{2,24}$')",
    "quoted": r"double(c.left rlike '[\x22\x27`]$')",
    "assigned": r"double(c.left rlike '[:=][ \x22\x27]*$')",
    "secret_word": r"double(lower(c.left) rlike 'token|secret|passw|pwd|api|auth|credential|key')",
    "contact_word": r"double(lower(c.left) rlike 'phone|tel|call|fax|mobil|mail|contact|reach')",
    "account_word": r"double(lower(c.left) rlike 'card|visa|iban|account|credit|konto|compte|cuenta')",
    "joined_left": r"double(c.left rlike '[0-9A-Za-z.,%$-]$')",
    "joined_right": r"double(c.right rlike '^[0-9A-Za-z%]')",
}

#: Weak labels of candidates of no base rule, by kind. Kinds without one (email and ip) are never
#: learnt: every email passes its rule, and octets above 255 are no address.
LABELS = {
    "secret": "secret_word = 1 and assigned = 1",
    "local_phone": "contact_word = 1 and digits between 7 and 15 and joined_left = 0 and joined_right = 0",
    "masked_email": "domain = 1",
    "card": "account_word = 1 and digits between 13 and 19 and joined_left = 0 and joined_right = 0",
    "phone": "contact_word = 1 and digits between 7 and 9 and joined_right = 0",
}
#: Candidates that the threshold decides on: of no base rule, and not inside a base span.
_REST = "filter(found, c -> not c.base and not exists(base_spans, b -> b.s <= c.s and b.e >= c.e))"


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _luhn(digits: str) -> str:
    """Whether a string of digits passes the Luhn check."""
    return (f"pmod(aggregate(transform(split(reverse({digits}), ''), (d, i) -> "
            "if(i % 2 = 0, try_cast(d as int), if(try_cast(d as int) > 4, 2 * try_cast(d as int) - 9, "
            "2 * try_cast(d as int)))), "
            "0, (a, d) -> a + coalesce(d, 0)), 10) = 0")


_OCTETS = (r"(m rlike '^[0-9]+([.][0-9]+){3}$' and forall(split(m, '[.]'), "
           r"p -> char_length(ltrim('0', p)) <= 3 and int(right(concat('000', ltrim('0', p)), 3)) <= 255))")
_DIGITS = "regexp_replace(m, '[^0-9]', '')"
RULES = {
    "email": "true",
    "ip": _OCTETS,
    "card": f"(char_length({_DIGITS}) between 14 and 19 and {_luhn(_DIGITS)})",
    "phone": f"(char_length({_DIGITS}) between 10 and 15)",
}


def _rule(kind: str, value: str) -> str:
    return RULES[kind].replace("(m rlike", f"({value} rlike").replace("split(m,", f"split({value},") \
        .replace("regexp_replace(m,", f"regexp_replace({value},")


def _found(docs: DataFrame) -> DataFrame:
    """Adds ``found``: all candidates as (kind, s, e, m, base), unsorted."""
    out = docs.withColumn("has_digit", F.expr(DIGIT))
    for kind in KINDS:
        pattern = _quoted({**BASE, **EXTRA}[kind])
        try_it = NEEDS.get(kind, "has_digit")
        out = out.select("*", F.expr(
            f"if({try_it}, regexp_extract_all(text, {pattern}, 0), cast(array() as array<string>))")
            .alias(f"m_{kind}"))
        out = out.select("*", F.expr(
            f"if(size(m_{kind}) > 0, split(text, {pattern}, -1), cast(array() as array<string>))")
            .alias("gaps"))
        # where match i starts: the sum of all gaps and matches before it, by blocks
        out = out.select("*", F.expr(
            f"transform(m_{kind}, (m, i) -> bigint(char_length(m) + char_length(get(gaps, i))))").alias("len"))
        out = out.select("*", F.expr(
            f"transform(sequence(0, int(size(len) / {_BLOCK})), b -> aggregate("
            f"slice(len, b * {_BLOCK} + 1, {_BLOCK}), 0L, (a, x) -> a + x))").alias("sums"))
        out = out.select("*", F.expr(
            "transform(sums, (s, b) -> aggregate(slice(sums, 1, b), 0L, (a, x) -> a + x))").alias("before"))
        valid = _rule(kind, "m") if kind in BASE else "false"
        out = out.select("*", F.expr(
            f"transform(m_{kind}, (m, i) -> named_struct('kind', '{kind}', 's', get(before, int(i / {_BLOCK})) "
            f"+ aggregate(slice(len, int(i / {_BLOCK}) * {_BLOCK} + 1, i % {_BLOCK}), 0L, (a, x) -> a + x) "
            f"+ char_length(get(gaps, i)), 'm', m, 'base', {valid}))").alias(f"c_{kind}"))
        out = out.drop(f"m_{kind}", "gaps", "len", "sums", "before")
    every = ", ".join(f"c_{k}" for k in KINDS)
    return (out.select("*", F.expr(f"transform(concat({every}), c -> named_struct('s', c.s, "
                                   f"'k', int(array_position(array({_kinds()}), c.kind)), 'e', c.s + char_length(c.m), "
                                   "'kind', c.kind, 'm', c.m, 'base', c.base))").alias("found"))
            .drop("has_digit", *[f"c_{k}" for k in KINDS]))


def _kinds() -> str:
    return ", ".join(f"'{k}'" for k in KINDS)


def _with_features(candidates: str) -> str:
    """SQL: candidates with the text around them, then with their features."""
    placed = (f"transform({candidates}, c -> named_struct('s', c.s, 'k', c.k, 'e', c.e, 'kind', c.kind, "
              f"'m', c.m, 'base', c.base, 'left', substring(text, int(greatest(1, c.s + 1 - {CONTEXT})), "
              f"int(least(c.s, {CONTEXT}))), 'right', substring(text, int(c.e + 1), 4)))")
    digits = "regexp_replace(c.m, '[^0-9]', '')"
    fields = ", ".join(
        f"'{name}', " + sql.replace("{kinds}", _kinds()).replace("{luhn}", _luhn(digits))
        .replace("{octets}", _rule("ip", "c.m")).replace(r"\x22", '"').replace(r"\x27", "\\'")
        for name, sql in FEATURES.items())
    return (f"transform({placed}, c -> named_struct('s', c.s, 'k', c.k, 'e', c.e, 'kind', c.kind, 'base', c.base, "
            f"'left', c.left, {fields}))")


@dataclass
class PiiModel:
    trees: Boosted | None
    threshold: float


def train_pii(docs: DataFrame, precision: float = PRECISION) -> PiiModel:
    """Trees and threshold from every candidate of all documents."""
    chosen = (docs.where(F.expr(" or ".join([DIGIT, *NEEDS.values()])))
              .select("doc_id", F.col("text").cast("string").alias("text")))
    weak = " or ".join(f"(kind = '{kind}' and {sql})" for kind, sql in LABELS.items())
    found = _found(chosen).withColumn("base_spans", F.expr("filter(found, c -> c.base)"))
    kinds = [*FEATURES, "base", "label", "fold"]
    # equal candidates are one row with their number; sorted, so sums are taken in one order
    rows = (found.select("doc_id", "text", F.explode(F.expr(
                _with_features(f"concat(base_spans, {_REST})"))).alias("f"))
            .select("doc_id", "f.*")
            .withColumn("label", F.expr(f"int(base or {weak})"))
            .withColumn("fold", F.expr("pmod(xxhash64(doc_id), 4)"))
            .groupBy(*kinds).agg(F.count(F.lit(1)).cast("double").alias("weight"))
            .sortWithinPartitions(*kinds).persist())
    try:
        trees = train(rows.where("fold > 0"), list(FEATURES), weight="weight")
        if trees is None:
            return PiiModel(None, 0.0)
        step = f"floor(({trees.sql('f')}) * {SCORE_STEPS}) / {SCORE_STEPS}D"
        held = (rows.where("fold = 0 and not base").select(F.struct(*FEATURES).alias("f"), "label", "weight")
                .groupBy(F.expr(step).alias("score"))
                .agg(F.sum(F.col("weight") * F.col("label")).alias("right"), F.sum("weight").alias("n")).collect())
    finally:
        rows.unpersist()
    return PiiModel(trees, lowest_score([(r.score, r.right, r.n) for r in held], precision))


def lowest_score(scored: list[tuple], precision: float) -> float:
    """The lowest score from which on the share of right ones is ``precision``; infinity without one.

    An entry is a score, the number of right ones and that of all (one, if left out)."""
    best, right, n = float("inf"), 0, 0
    scored = sorted(scored, reverse=True)
    for i, (score, good, *rows) in enumerate(scored, 1):
        right, n = right + good, n + (rows[0] if rows else 1)
        # rows of one score are accepted together
        if (i == len(scored) or scored[i][0] < score) and right >= precision * n:
            best = score
    return best


def pii_spans(docs: DataFrame, model: PiiModel) -> DataFrame:
    """Adds ``base_spans`` and ``spans``: arrays of (s, k, e, kind) by start, then kind as listed."""
    span = "transform({}, c -> named_struct('s', c.s, 'k', c.k, 'e', c.e, 'kind', c.kind))"
    found = _found(docs).select("*", F.expr("sort_array(" + span.format("filter(found, c -> c.base)") + ")")
                                .alias("base_spans"))
    if model.trees is None or model.threshold == float("inf"):
        return found.withColumn("spans", F.col("base_spans")).drop("found")
    accepted = f"filter(features, c -> {model.trees.sql('c')} >= {model.threshold!r}D)"
    return (found.select("*", F.expr(_with_features(_REST)).alias("features"))
            .select("*", F.expr("sort_array(concat(base_spans, " + span.format(accepted) + "))").alias("spans"))
            .drop("found", "features"))


def _digest_text(spans: str) -> str:
    return f"array_join(transform({spans}, c -> concat(c.kind, ':', c.s, ':', c.e)), ',')"


def pii_report(docs: DataFrame, model: PiiModel) -> DataFrame:
    """Counts and digests of the spans of every document."""
    counts = [F.expr(f"bigint(size(filter(base_spans, c -> c.kind = '{k}')))").alias(f"n_{k}") for k in BASE]
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return pii_spans(rows, model).select(
        "doc_id", *counts, F.sha2(F.expr(_digest_text("base_spans")), 256).alias("base_sha256"),
        F.expr(_digest_text("spans")).alias("spans"))


def redact(docs: DataFrame, model: PiiModel) -> DataFrame:
    """``docs`` with every span of ``text`` replaced by its kind in brackets.

    Of overlapping spans the joint stretch is replaced once, by the first kind.
    A column n_chars, if there is one, gets the new length.
    """
    rows = docs.select(F.struct("*").alias("row"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    cut = pii_spans(rows, model).select("*", F.expr("""
        aggregate(spans, cast(array() as array<struct<s: bigint, e: bigint, kind: string>>), (done, c) ->
            if(size(done) > 0 and element_at(done, -1).e > c.s,
               concat(slice(done, 1, size(done) - 1), array(named_struct('s', element_at(done, -1).s,
                      'e', greatest(element_at(done, -1).e, c.e), 'kind', element_at(done, -1).kind))),
               concat(done, array(named_struct('s', c.s, 'e', c.e, 'kind', c.kind)))))""").alias("cuts"))
    cleaned = cut.select("row", "cuts", F.expr("""if(size(cuts) = 0, row.text, concat(array_join(
        transform(cuts, (c, i) -> concat(
            substring(text, int(if(i = 0, 0L, get(cuts, i - 1).e) + 1), int(c.s - if(i = 0, 0L, get(cuts, i - 1).e))),
            '[', upper(c.kind), ']')), ''),
        substring(text, int(element_at(cuts, -1).e + 1), char_length(text))))""").alias("clean"))

    def column(name: str) -> Column:
        if name == "text":
            return F.col("clean").alias(name)
        own = F.col("row")[name]
        if name == "n_chars":
            own = F.when(F.size("cuts") > 0, F.char_length("clean")).otherwise(own).cast(docs.schema[name].dataType)
        return own.alias(name)

    return cleaned.select(*[column(c) for c in docs.columns])
