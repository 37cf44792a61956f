r"""Find personal data with fixed patterns and a boosted-tree model, with SQL functions only.

Base spans come from four patterns and their checks.  A generator with wider patterns proposes
further, overlapping candidates, with one or more patterns per kind: addresses with the signs spelled
out, dotted or bracketed numbers, numbers with a dialling prefix, national numbers in groups.  Features of a candidate's format and context go to gradient-boosted
trees; the trees become one SQL expression, so that all work on a document happens in its row.

All texts are searched for base spans.  The trees learn from the spans of all different texts: the
spans as they stand and in disguise are examples, the same spans damaged so that they can be nobody's
data are counterexamples.  Examples with equal features are counted and weigh as many, so that
training takes one row for each different set of features, however many spans there are.  Thresholds
per kind are calibrated on all examples held out: the lowest score above which nearly all held-out
examples are true.  A caller may ask for fewer texts (``sample_documents``); no query does.  Without
enough examples nothing is added.  Added spans never replace base spans; they have kinds of their own
(``likely_...``) and do not overlap base spans or better spans that are added.

Positions are code points.  Defined cases: a null text has no spans; repeated rows are treated
each; an empty table gives an empty result.

The patterns run without backtracking over long runs: quantifiers are possessive where what follows
cannot match what they take, and a match may only begin where a run begins or the last match ended.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adloom.llm.common import column, drop_saved, fresh, saved

KINDS = ("email", "ip", "card", "phone")

# Base patterns by kind; matches are those of the plain forms in the contract of the result.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}

# The generators' wider patterns; a name's first part is the kind it proposes.
_DOT = r"(?:\.|\x20?[\[(](?:\.|dot)[\])]\x20?)"
WIDE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?(?:@|[\[(](?:@|at)[\])])\x20?"
    rf"[A-Za-z0-9-]++(?:{_DOT}[A-Za-z0-9-]++)++",
    "email_words": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++(?i:\x20at\x20)[A-Za-z0-9-]++"
    r"(?:(?i:\x20dot\x20|\.)[A-Za-z0-9-]++)++",
    "ip": rf"(?<![0-9.])[0-9]{{1,3}}+(?:{_DOT}[0-9]{{1,3}}+){{3}}+(?![0-9])",
    "card": r"(?<![0-9])[0-9](?:[\x20._/-]?[0-9]){11,18}+(?![0-9])",
    "phone": r"(?<![0-9])(?:00|\()[0-9](?:[\x20()./-]{0,2}+[0-9]){7,14}+(?![0-9])",
    "phone_groups": r"(?<![0-9])(?<![0-9][\x20./-])[(]?[0-9]{3}(?:[)]\x20?|[\x20./-])[0-9]{3}"
    r"[\x20.-][0-9]{4}(?![\x20./-]?[0-9])",
    "phone_area": r"(?<![0-9])(?<![0-9][\x20./-])[(]?0[1-9][0-9]{1,4}+(?:[)]\x20?|[\x20/-])"
    r"[0-9]{3,8}+(?:[\x20-][0-9]{2,5}+){0,2}+(?![\x20./-]?[0-9])",
}

# Formats that tell addresses in words and national numbers from their lookalikes.
_SHAPES = (
    r"(?i)\x20at\x20.*\x20dot\x20[a-z]{2,}$",
    r"^[(]?[2-9][0-9]{2}(?:[)]\x20?|[\x20./-])[2-9][0-9]{2}[\x20.-][0-9]{4}$",
    r"^[(]?0[1-9][0-9]{1,4}(?:[)]\x20?|[\x20/-])[1-9][0-9]{5,7}$",
)

CONTEXT = 16
CUES = (
    "mail|contact|phone|tel|call|mobile|fax|card|visa|payment|karte|carte|tarjeta|host|server|"
    "address|adresse|direcci"
)

_BLOCK = 256

# Characters of the pieces that a text with spans is cut into.
_PIECE = 64

# Levels of digests for each doubling, and the fewest partitions of what is learned from; more only
# where so many different examples ask for them, so that both depend on the rows alone.
_LEVELS = 64
_SAMPLE_PARTS = 8
_PART_EXAMPLES = 50_000


@dataclass(frozen=True)
class PiiRule:
    # Texts to learn from for each kind; all of them unless a number is given.
    sample_documents: int | None = None
    trees: int = 8
    depth: int = 4
    precision: float = 0.995
    least_examples: int = 40
    seed: int = 7


@dataclass(frozen=True)
class PiiModel:
    """The trees as a SQL expression over the array ``x``, and the least score by kind."""

    score: str
    thresholds: dict[str, float]


def sql(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _running(values: str, step: str = "total + x") -> str:
    """Running sums of an array column: within blocks, on top of the blocks before.

    ``values`` is a plain column name, as the expression refers to it for every element.  Other
    steps than a sum must also be free to join blocks in any way, like the largest of two.
    """
    total = f"CAST(0 AS BIGINT), (total, x) -> {step}"
    blocks = f"sequence(0, CAST((size({values}) - 1) DIV {_BLOCK} AS INT))"
    before = (
        f"transform({blocks}, b -> aggregate(slice({values}, 1, b * {_BLOCK}), {total}))"
    )
    joined = step.replace("total", "start").replace(
        "x", f"aggregate(slice({values}, b * {_BLOCK} + 1, i), {total})"
    )
    within = f"""transform({before}, (start, b) -> transform(
        sequence(1, least({_BLOCK}, size({values}) - b * {_BLOCK})),
        i -> {joined}))"""
    return f"IF(size({values}) = 0, array(), flatten({within}))"


def _clustered(frame: DataFrame, spans: str, name: str) -> DataFrame:
    """Add a column with the spans, sorted by start, cut where none reaches over.

    Spans that overlap are in one cluster, so that what depends on overlaps is settled within the
    few spans of a cluster, however many the text has.
    """
    tops, firsts = f"{name}_tops", f"{name}_firsts"
    reached = _running(f"{name}_ends", "if(x > total, x, total)")
    frame = frame.withColumn(f"{name}_ends", F.expr(f"transform({spans}, s -> s.end)"))
    # The optimizer may put a step in place of its name, so no lambda refers to one it runs through.
    cut_before = f"zip_with({spans}, concat(array(0L), {tops}), (s, top) -> s.start >= top)"
    numbered = f"transform({cut_before}, (cut, i) -> IF(cut AND i < size({spans}), i, NULL))"
    frame = frame.withColumn(tops, F.expr(reached)).withColumn(
        firsts, F.expr(f"filter({numbered}, i -> i IS NOT NULL)")
    )
    following = f"coalesce(get({firsts}, j + 1), size({spans}))"
    # Taken one by one: a slice would go through the whole array each time.
    cut = f"transform({firsts}, (i, j) -> transform(sequence(i, {following} - 1), k -> {spans}[k]))"
    return frame.withColumn(name, F.expr(cut)).drop(f"{name}_ends", tops, firsts)


def _pieces(text: str) -> str:
    """A text in pieces of equal length, of which a part is taken without walking up to it."""
    return f"regexp_extract_all({text}, '(?s).{{1,{_PIECE}}}', 0)"


def _part(pieces: str, start: str, end: str) -> str:
    first, last = f"CAST(({start}) DIV {_PIECE} AS INT)", f"CAST(({end}) DIV {_PIECE} AS INT)"
    own = f"array_join(transform(sequence({first}, {last}), k -> coalesce(get({pieces}, k), '')), '')"
    return f"substr({own}, CAST(({start}) % {_PIECE} + 1 AS INT), CAST(({end}) - ({start}) AS INT))"


def _located(frame: DataFrame, text: str, patterns: dict[str, str], gates: dict[str, str],
             prefix: str) -> DataFrame:
    """Add a column per pattern, ``prefix`` and its name, with its matches and their places.

    Text between matches and the matches themselves come from splitting and extracting with the
    same pattern; running sums of their lengths are the places.
    """
    levels: list[dict[str, object]] = [{}, {}, {}, {}]
    for kind, pattern in patterns.items():
        found, steps, ends = (f"{prefix}{kind}_{part}" for part in ("found", "steps", "ends"))
        levels[0][found] = F.expr(
            f"IF({gates[kind]}, regexp_extract_all({text}, {sql(pattern)}, 0),"
            " CAST(array() AS array<string>))"
        )
        levels[1][steps] = F.expr(
            f"""IF(size({found}) = 0, CAST(array() AS array<int>), zip_with(
                slice(split({text}, {sql(pattern)}, -1), 1, size({found})), {found},
                (a, b) -> length(a) + length(b)))"""
        )
        levels[2][ends] = F.expr(_running(steps))
        levels[3][f"{prefix}{kind}"] = F.expr(
            f"""zip_with({ends}, {found}, (e, v) -> struct({sql(kind.split("_")[0])} AS kind,
                CAST(e - length(v) AS BIGINT) AS start, CAST(e AS BIGINT) AS end, v AS value))"""
        )
    for level in levels:
        frame = frame.withColumns(level)
    return frame.drop(
        *[f"{prefix}{kind}_{part}" for kind in patterns for part in ("found", "steps", "ends")]
    )


def _luhn(value: str) -> str:
    """Whether 12 to 19 digits among other characters pass the checksum."""
    digits = f"regexp_replace({value}, '[^0-9]', '')"
    return f"""(length({digits}) BETWEEN 12 AND 19 AND aggregate(
        transform(split(reverse({digits}), ''), (d, i) -> IF(d = '', 0,
            IF(i % 2 = 0, CAST(d AS INT),
                IF(CAST(d AS INT) > 4, CAST(d AS INT) * 2 - 9, CAST(d AS INT) * 2)))),
        0, (total, x) -> total + x) % 10 = 0)"""


def _octets(value: str) -> str:
    parts = f"filter(split({value}, '[^0-9]+'), p -> p != '')"
    small = sql("^0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$")
    return f"forall({parts}, p -> p RLIKE {small})"


_CHECKS = {
    "email": "true",
    "ip": _octets("s.value"),
    "card": _luhn("s.value"),
    "phone": "length(regexp_replace(s.value, '[^0-9]', '')) BETWEEN 9 AND 15",
}


def with_base_spans(frame: DataFrame, text: str) -> DataFrame:
    """Add ``base``: the checked spans of all kinds with their values, unsorted."""
    gates = {
        "email": f"coalesce(instr({text}, '@') > 0, false)",
        "phone": f"coalesce(instr({text}, '+') > 0 AND has_digit, false)",
        "ip": "has_digit",
        "card": "has_digit",
    }
    frame = frame.withColumn("has_digit", F.expr(f"coalesce({text} RLIKE '[0-9]', false)"))
    frame = _located(frame, text, PATTERNS, gates, "b_")
    checked = [f"filter(b_{kind}, s -> {_CHECKS[kind]})" for kind in KINDS]
    return frame.withColumn("base", F.expr(f"concat({', '.join(checked)})")).drop(
        *[f"b_{kind}" for kind in KINDS]
    )


def _features(kind: str, value: str, left: str, right: str) -> str:
    """Format and context of a candidate as an array of numbers."""

    def number(condition: str) -> str:
        return f"IF({condition}, 1D, 0D)"

    def count(pattern: str) -> str:
        return f"CAST(length({value}) - length(regexp_replace({value}, {sql(pattern)}, '')) AS DOUBLE)"

    digits = f"regexp_replace({value}, '[^0-9]', '')"
    return "array(" + ", ".join(
        [
            f"CAST(array_position(array('email', 'ip', 'card', 'phone'), {kind}) AS DOUBLE)",
            f"CAST(length({value}) AS DOUBLE)",
            f"CAST(length({digits}) AS DOUBLE)",
            count("[A-Za-z]"),
            count(r"[@\[\]()]"),
            count(r"[\x20._/-]"),
            number(_luhn(value)),
            number(_octets(value)),
            number(f"{value} RLIKE {sql(r'^(?:[+]|00|[(])')}"),
            number(f"{value} RLIKE {sql(r'[.)\]][\x20]?[A-Za-z]{2,}$')}"),
            f"CAST(size(array_distinct(split({digits}, ''))) AS DOUBLE)",
            number(f"{left} RLIKE {sql('[A-Za-z0-9]$')}"),
            number(f"{right} RLIKE {sql('^[A-Za-z0-9]')}"),
            number(f"{left} RLIKE {sql('(?i)(?:' + CUES + ')')}"),
            *(number(f"{value} RLIKE {sql(shape)}") for shape in _SHAPES),
        ]
    ) + ")"


def _context(pieces: str, start: str, end: str) -> tuple[str, str]:
    left = _part(pieces, f"greatest(0, {start} - {CONTEXT})", start)
    return left, _part(pieces, end, f"{end} + {CONTEXT}")


def _known(docs: DataFrame, text: str) -> DataFrame:
    """The base spans of all texts with their context, those of equal texts once.

    ``level`` is the logarithm of the text's digest, so that few levels tell small digests apart.
    """
    found = with_base_spans(docs.select(column(text).alias("text")), "text")
    # The generator keeps the filter from being pushed into the patterns' expressions.
    found = found.select("text", F.explode(F.array("base")).alias("base")).where("size(base) > 0")
    found = found.withColumn("digest", F.expr("xxhash64(text) & 9223372036854775807"))
    found = found.withColumn("pieces", F.expr(_pieces("text")))
    left, right = _context("pieces", "s.start", "s.end")
    spans = found.select("pieces", "digest", F.explode("base").alias("s"))
    return spans.selectExpr(
        "digest", f"CAST(floor({_LEVELS} * log2(1D + digest)) AS INT) AS level", "s.kind",
        "s.start", "s.value AS v", f"{left} AS l", f"{right} AS r",
    ).distinct()


def _sampled(known: DataFrame, rule: PiiRule) -> DataFrame:
    """The spans of each kind in about ``sample_documents`` texts, those with the smallest digests."""
    levels = (
        known.select("kind", "level", "digest")
        .distinct()
        .groupBy("kind", "level")
        .agg(F.count(F.lit(1)).alias("n"))
        .collect()
    )
    last = {}
    for kind in KINDS:
        n = 0
        for row in sorted((row for row in levels if row.kind == kind), key=lambda row: row.level):
            if n < rule.sample_documents:
                last[kind], n = row.level, n + row.n
    limits = " ".join(f"WHEN kind = '{kind}' THEN {level}" for kind, level in last.items())
    return known.where(f"level <= CASE {limits} ELSE -1 END" if limits else "false")


def _examples(spans: DataFrame) -> DataFrame:
    """Labelled rows ``kind, x, label, held_out`` made from base spans."""
    digits = "regexp_replace(v, '[^0-9]', '')"
    # Ten digits as they may stand after a country's code, groups of three not led by 0 or 1.
    local = (
        f"regexp_replace(regexp_replace(right(concat('2345678', {digits}), 10),"
        " '^[01]', '5'), '^(...)[01]', '$15')"
    )
    grouped = f"regexp_replace({digits}, '([0-9]{{4}})(?=[0-9])', '$1.')"
    # True: as found and in disguise.  False: damaged so that no check of its kind can hold.
    variants = {
        "email": [
            ("v", 1),
            ("replace(v, '@', ' [at] ')", 1),
            ("replace(replace(v, '@', '(at)'), '.', '(dot)')", 1),
            ("replace(replace(v, '@', ' at '), '.', ' dot ')", 1),
            ("replace(regexp_replace(v, '^[^@]*@', 'al at '), '.', ' dot ')", 1),
            ("regexp_replace(v, '[.][^@]*$', '')", 0),
            ("regexp_replace(v, '^[^@]*@', 'look at ')", 0),
            ("replace(regexp_replace(regexp_replace(v, '^[^@]*@', 'look at '), '[.][^.]*$',"
             " '.1'), '.', ' dot ')", 0),
            ("replace(regexp_replace(regexp_replace(v, '^[^@]*@', 'documentation at '),"
             " '[.][^.]*$', '.2024'), '.', ' dot ')", 0),
            ("regexp_replace(regexp_replace(v, '^[^@]*@', 'a@'), '[.][^.]*$', '.1')", 0),
        ],
        "ip": [
            ("v", 1),
            ("replace(v, '.', '[.]')", 1),
            ("concat('7', lpad(v, 15, '8'))", 0),
            ("regexp_replace(v, '^[0-9]+', '300')", 0),
            ("regexp_replace(v, '[0-9]+$', '999')", 0),
        ],
        "card": [
            ("v", 1),
            (grouped, 1),
            ("concat(substr(v, 1, length(v) - 1), CAST((CAST(right(v, 1) AS INT) + 3) % 10"
             " AS STRING))", 0),
            (f"concat(substr({grouped}, 1, length({grouped}) - 1),"
             f" CAST((CAST(right(v, 1) AS INT) + 5) % 10 AS STRING))", 0),
        ],
        "phone": [
            ("v", 1),
            ("concat('00', substr(v, 2))", 1),
            (f"regexp_replace({local}, '^(...)(...)', '$1-$2-')", 1),
            (f"regexp_replace({local}, '^(...)(...)', '($1) $2-')", 1),
            (f"concat('0', regexp_replace({local}, '^(..).', '$1 '))", 1),
            (f"concat('0', regexp_replace({local}, '^(...)', '$1/'))", 1),
            (f"regexp_replace({local}, '^.(..).(..)', '1$1-0$2-')", 0),
            (f"concat('0', regexp_replace({local}, '^(..)..', '$1 0'))", 0),
            (f"concat('0', regexp_replace({local}, '^(..)(...)(...).*', '$1-$2-$3'))", 0),
            (f"substr({digits}, 1, 9)", 0),
            (f"concat('00', repeat('0', 4), substr({digits}, 1, 5))", 0),
        ],
    }
    cases = " ".join(
        f"WHEN kind = '{kind}' THEN array("
        + ", ".join(f"struct({value} AS v, CAST({label} AS DOUBLE) AS label)" for value, label in of)
        + ")"
        for kind, of in variants.items()
    )
    rows = spans.selectExpr("kind", "l", "r", f"inline(CASE {cases} END)")
    return rows.selectExpr(
        "kind",
        f"{_features('kind', 'v', 'l', 'r')} AS x",
        "label",
        "pmod(xxhash64(kind, v, l), 10) < 4 AS held_out",
    )


def _counted(spans: DataFrame) -> DataFrame:
    """The examples made from all spans, equal ones in one row with their number ``n``."""
    return (
        _examples(spans)
        .groupBy("kind", "x", "label", "held_out")
        .agg(F.count(F.lit(1)).cast("double").alias("n"))
    )


def _bins(different: int) -> int:
    """Bins for which Spark ML takes a feature's possible limits from all rows, not from some of them.

    It draws as many rows as the square of the bins, but 10,000 at least.
    """
    return 32 if different <= 10_000 else math.isqrt(different - 1) + 1


def tree_expression(model: GBTClassificationModel) -> str:
    """The boosted trees as a SQL expression over the array ``x``: the probability of class 1."""

    def branch(lines: list[str]) -> str:
        line = lines.pop(0).strip()
        if line.startswith("Predict"):
            return f"CAST({line.split()[-1]} AS DOUBLE)"
        feature, limit = re.fullmatch(r"If \(feature (\d+) <= (\S+)\)", line).groups()
        first = branch(lines)
        lines.pop(0)
        return f"IF(x[{feature}] <= {limit}D, {first}, {branch(lines)})"

    trees = [
        f"{weight}D * {branch(tree.toDebugString.strip().splitlines()[1:])}"
        for tree, weight in zip(model.trees, model.treeWeights)
    ]
    return f"1 / (1 + exp(-2 * ({' + '.join(trees)})))"


def learn(docs: DataFrame, text: str, rule: PiiRule) -> PiiModel:
    """Fit the trees on part of the examples and set each kind's threshold on the rest."""
    known = _known(docs, text)
    if rule.sample_documents is None:
        rows = saved(_counted(known), "pii-examples")
    else:
        known = saved(known, "pii-known")
        rows = saved(_counted(_sampled(known, rule)), "pii-examples")
        drop_saved(known)
    sizes = {
        (row.held_out, row.label): row
        for row in rows.groupBy("held_out", "label")
        .agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("different"))
        .collect()
    }
    sides = [(held, label) for held in (False, True) for label in (0.0, 1.0)]
    if min(sizes[side].n if side in sizes else 0 for side in sides) < rule.least_examples:
        drop_saved(rows)
        return PiiModel("0D", {})
    different = sum(row.different for (held, _), row in sizes.items() if not held)
    trainer = GBTClassifier(
        featuresCol="features", labelCol="label", weightCol="n", maxIter=rule.trees,
        maxDepth=rule.depth, maxBins=_bins(different), seed=rule.seed,
    )
    # In an order of their own, so that the trees do not depend on how the input is cut into files.
    ordered = (
        rows.where("NOT held_out")
        .repartition(max(_SAMPLE_PARTS, -(-different // _PART_EXAMPLES)), "x", "label")
        .sortWithinPartitions("x", "label")
    )
    model = trainer.fit(ordered.select(array_to_vector("x").alias("features"), "label", "n"))
    score = tree_expression(model)
    bins = (
        rows.where("held_out")
        .selectExpr("kind", "label", "n", f"CAST(floor(100 * ({score})) AS INT) AS bin")
        .groupBy("kind", "bin")
        .agg(F.sum(F.col("label") * F.col("n")).alias("right"), F.sum("n").alias("n"))
        .collect()
    )
    drop_saved(rows)
    thresholds = {}
    for kind in KINDS:
        right = n = 0
        for row in sorted((b for b in bins if b.kind == kind), key=lambda b: -b.bin):
            right, n = right + row.right, n + row.n
            if right < rule.precision * n:
                break
            if n >= rule.least_examples:
                thresholds[kind] = max(0.5, row.bin / 100)
    return PiiModel(score, thresholds)


def with_spans(frame: DataFrame, text: str, model: PiiModel) -> DataFrame:
    """Add ``base`` and ``spans``, both sorted by place and kind; ``spans`` has the added ones too."""
    frame = with_base_spans(frame, text)
    order = f"array_position(array{KINDS}, s.kind)"
    if not model.thresholds:
        added = "CAST(array() AS array<struct<kind: string, start: bigint, end: bigint>>)"
        frame = frame.withColumn("added", F.expr(added))
    else:
        words = r"(?i)\x20at\x20[a-z0-9-]++(?:\x20dot\x20|\.)[a-z0-9-]"
        gates = {
            "email": f"coalesce({text} RLIKE {sql(r'@|[\[(]at[\])]')}, false)",
            "email_words": f"coalesce({text} RLIKE {sql(words)}, false)",
            "ip": "has_digit",
            "card": "has_digit",
            "phone_groups": f"has_digit AND coalesce({text} RLIKE '[0-9]{{3}}[ .-][0-9]{{4}}', false)",
            "phone_area": f"has_digit AND coalesce({text} RLIKE '0[1-9][0-9]{{1,4}}[) /-]', false)",
            "phone": f"has_digit AND coalesce({text} RLIKE {sql('00|[(][0-9]')}, false)",
        }
        frame = _located(frame, text, WIDE, gates, "w_")
        # Candidates that overlap no base span.
        known = "struct(s.start AS start, s.end AS end, s.kind AS kind, s.value AS value, {} AS known)"
        wide = f"concat({', '.join(f'w_{name}' for name in WIDE)})"
        # Where nothing is proposed, nothing is compared.
        needed = f"IF(size({wide}) = 0, slice(base, 1, 0), base)"
        frame = frame.withColumn("both", F.expr(needed))
        both = f"""sort_array(concat(transform(both, s -> {known.format('true')}),
            transform({wide}, s -> {known.format('false')})))"""
        frame = _clustered(frame.withColumn("both", F.expr(both)), "both", "met")
        new = """flatten(transform(met, g -> filter(g, s -> NOT s.known AND
            NOT exists(g, b -> b.known AND b.start < s.end AND s.start < b.end))))"""
        frame = frame.withColumn("new", F.expr(new)).withColumn(
            "pieces", F.expr(f"IF(size(new) > 0, {_pieces(text)}, NULL)")
        )
        left, right = _context("pieces", "s.start", "s.end")
        frame = frame.withColumn(
            "proposed",
            F.expr(
                f"""transform(new, s -> struct(s.kind AS kind, s.start AS start, s.end AS end,
                    {_features("s.kind", "s.value", left, right)} AS x))"""
            ),
        )
        limits = " ".join(
            f"WHEN s.kind = '{kind}' THEN {limit}D" for kind, limit in model.thresholds.items()
        )
        score = re.sub(r"\bx\[", "s.x[", model.score)
        frame = frame.withColumn(
            "scored",
            F.expr(
                f"""filter(transform(proposed, s -> struct(s.kind AS kind, s.start AS start,
                    s.end AS end, {score} AS score)),
                    s -> s.score >= CASE {limits} ELSE 2D END)"""
            ),
        )
        # By score, then place and kind; a span is taken if it overlaps none taken before.
        taken = "array<struct<score: double, start: bigint, place: bigint, end: bigint, kind: string>>"
        frame = frame.withColumn(
            "scored",
            F.expr(
                f"""sort_array(transform(scored, s -> struct(s.start AS start, {order} AS place,
                    s.end AS end, s.kind AS kind, s.score AS score)))"""
            ),
        )
        by_score = """sort_array(transform(g, s -> struct(-s.score AS score, s.start AS start,
            s.place AS place, s.end AS end, s.kind AS kind)))"""
        frame = _clustered(frame, "scored", "rivals").withColumn(
            "added",
            F.expr(
                f"""transform(flatten(transform(rivals, g -> aggregate({by_score},
                    CAST(array() AS {taken}), (done, s) -> IF(exists(done,
                        o -> o.start < s.end AND s.start < o.end), done, concat(done, array(s)))))),
                    s -> struct(concat('likely_', s.kind) AS kind, s.start AS start,
                        s.end AS end))"""
            ),
        ).drop(
            "proposed", "scored", "rivals", "both", "met", "new", "pieces",
            *[f"w_{name}" for name in WIDE],
        )

    def in_order(spans: str, kinds: tuple[str, ...]) -> str:
        # Sort by start, then kind as listed; the struct's fields sort in that order.
        keyed = f"""transform({spans}, s -> struct(s.start AS start,
            array_position(array{kinds}, s.kind) AS place, s.end AS end, s.kind AS kind))"""
        return f"sort_array({keyed})"

    kinds = (*KINDS, *(f"likely_{kind}" for kind in KINDS))
    plain = "transform(base, s -> struct(s.kind AS kind, s.start AS start, s.end AS end))"
    return (
        frame.withColumn("spans", F.expr(in_order(f"concat({plain}, added)", kinds)))
        .withColumn("base", F.expr(in_order(plain, KINDS)))
        .drop("added", "has_digit")
    )


def _listed(spans: str) -> str:
    return f"""array_join(transform({spans}, s -> concat(s.kind, ':', CAST(s.start AS STRING),
        ':', CAST(s.end AS STRING))), ',')"""


def find_pii(
    docs: DataFrame, rule: PiiRule = PiiRule(), doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Spans of every document: counts and a digest of the base spans, and the list of all."""
    model = learn(docs, text, rule)
    narrow = docs.select(column(doc_id).alias("doc_id"), column(text).alias("text"))
    found = with_spans(narrow, "text", model)
    return found.select(
        F.col("doc_id").alias(doc_id),
        *[
            F.expr(f"CAST(size(filter(base, s -> s.kind = '{kind}')) AS BIGINT)").alias(f"n_{kind}")
            for kind in KINDS
        ],
        F.expr(f"sha2({_listed('base')}, 256)").alias("base_sha256"),
        F.expr(_listed("spans")).alias("spans"),
    )


def redacted(docs: DataFrame, rule: PiiRule = PiiRule(), text: str = "text") -> DataFrame:
    """The documents with every span replaced by its kind in brackets; overlapping ones by one.

    Other columns stay as they are; a text without spans stays itself.
    """
    model = learn(docs, text, rule)
    row = fresh(["text"], "whole_row")
    packed = docs.select(
        F.struct(*[column(name) for name in docs.columns]).alias(row), column(text).alias("text")
    )
    found = _clustered(with_spans(packed, "text", model), "spans", "groups")
    merged = """transform(groups, g -> struct(g[0].start AS start,
        array_max(transform(g, s -> s.end)) AS end, g[0].kind AS kind))"""
    found = found.withColumn("merged", F.expr(f"IF(size(groups) > 0, {merged}, NULL)")).withColumn(
        "pieces", F.expr(f"IF(size(groups) > 0, {_pieces('text')}, NULL)")
    )
    before = _part("pieces", "last", "s.start")
    replaced = f"""IF(merged IS NULL, text, concat(
        array_join(zip_with(merged, concat(array(CAST(0 AS BIGINT)),
            slice(transform(merged, s -> s.end), 1, size(merged) - 1)),
            (s, last) -> concat({before}, '[', upper(replace(s.kind, 'likely_', '')), ']')), ''),
        {_part("pieces", "merged[size(merged) - 1].end", "length(text)")}))"""
    found = found.withColumn("clean", F.expr(replaced))
    return found.select(
        *[
            F.col("clean").alias(name) if name == text else F.col(row).getField(name).alias(name)
            for name in docs.columns
        ]
    )
