"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document; the ledger stores what was measured and
one failure bit per rule.  A policy is a versioned mask over the bits, so trying
another policy, or leaving a rule out, is a bitwise pass over stored rows and
never a second look at a text.  All steps are built-in expressions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.tables import WHITE

_GAP = r"[\x20\x09-\x0D]+"
_SYMBOLS = r"[#*$%&|<>]"

#: Bit of each rule; a bit keeps its meaning in every version.
RULES = {
    "few_words": 1 << 0,
    "repeated_words": 1 << 1,
    "symbols": 1 << 2,
    "capitals": 1 << 3,
    "repeated_lines": 1 << 4,
    "word_length": 1 << 5,
}

MEASURES = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_capitals",
)


@dataclass(frozen=True)
class Policy:
    """Which rules reject a document."""

    name: str
    version: int
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(RULES[rule] for rule in self.rules)


BASE = Policy("base", 1, ("few_words", "repeated_words"))
PROSE = Policy("prose", 1, tuple(RULES))


def measure(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` and the measurements of each text.

    A null text is the empty text; all its measurements are 0.  Repeated rows are
    measured one by one.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    trimmed = F.btrim(body, F.lit(WHITE))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, _GAP))
    lines = F.filter(F.split(body, "\n", -1), lambda x: F.btrim(x, F.lit(WHITE)) != "")
    staged = docs.select(
        *[F.col(k) for k in keep],
        words.alias("_words"),
        lines.alias("_lines"),
        F.regexp_count(body, F.lit(_SYMBOLS)).cast("long").alias("n_symbols"),
        F.regexp_count(body, F.lit("[A-Z]")).cast("long").alias("n_capitals"),
        (F.length(body) - F.length(F.regexp_replace(body, _GAP, ""))).alias("_white"),
        F.length(body).alias("_chars"),
    )
    staged = staged.withColumn("_n", F.size("_words"))
    # A text without two equal hashes has no repeated window; only the others are compared word for word.
    starts = F.sequence(F.lit(0), F.col("_n") - 3)
    word = lambda i: F.get(F.col("_words"), i)
    staged = staged.withColumn(
        "_hashes",
        F.when(
            F.col("_n") >= 3,
            F.transform(starts, lambda i: F.xxhash64(word(i), word(i + 1), word(i + 2))),
        ).otherwise(F.array().cast("array<bigint>")),
    )
    staged = staged.withColumn(
        "_windows",
        F.when(
            F.size(F.array_distinct("_hashes")) < F.size("_hashes"),
            F.sort_array(
                F.transform(
                    starts,
                    lambda i: F.struct(
                        F.concat_ws(" ", word(i), word(i + 1), word(i + 2)).alias("w"), i.alias("i")
                    ),
                )
            ),
        ),
    )
    other = lambda k: F.get(F.col("_windows"), k)["w"]
    repeated = F.filter(
        "_windows",
        lambda x, k: F.coalesce(x["w"] == other(k - 1), F.lit(False))
        | F.coalesce(x["w"] == other(k + 1), F.lit(False)),
    )
    marked = F.flatten(F.transform(repeated, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))
    return staged.select(
        *keep,
        F.col("_n").cast("long").alias("n_words"),
        (F.col("_chars") - F.col("_white")).cast("long").alias("word_chars"),
        "n_symbols",
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.col("_windows").isNull(), F.lit(0))
        .otherwise(F.size(F.array_distinct(marked)))
        .cast("long")
        .alias("n_repeat_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        "n_capitals",
    )


def _failing() -> dict[str, Column]:
    """When each rule fails, from the measurements alone; whole numbers throughout."""
    n = F.col("n_words")
    return {
        "few_words": n < 50,
        "repeated_words": 100 * F.col("n_repeat_words") > 50 * n,
        "symbols": 100 * F.col("n_symbols") > 25 * n,
        "capitals": 100 * F.col("n_capitals") > 50 * F.col("word_chars"),
        "repeated_lines": 100 * F.col("n_dup_lines") > 60 * F.col("n_lines"),
        "word_length": (F.col("word_chars") < 2 * n) | (F.col("word_chars") > 20 * n),
    }


def failure_bits() -> Column:
    bits = [F.when(test, F.lit(RULES[rule])).otherwise(F.lit(0)) for rule, test in _failing().items()]
    mask = bits[0]
    for bit in bits[1:]:
        mask = mask.bitwiseOR(bit)
    return mask.cast("int")


def ledger(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep``, the measurements and ``failures``, a bit for each rule that failed."""
    return measure(docs, text, keep).withColumn("failures", failure_bits())


def passes(policy: Policy) -> Column:
    return F.col("failures").bitwiseAND(F.lit(policy.mask)) == 0


def apply_policy(rows: DataFrame, policy: Policy) -> DataFrame:
    """The ledger with ``kept`` and the policy that decided it."""
    return rows.withColumns({
        "kept": passes(policy),
        "policy": F.lit(policy.name),
        "policy_version": F.lit(policy.version),
    })


def ablations(rows: DataFrame, policies: tuple[Policy, ...] = (BASE, PROSE)) -> DataFrame:
    """For each policy and rule: documents, rejected ones, those the rule fails, and those it alone fails.

    ``only_this`` is what leaving the rule out would win back.  One pass, one row out of
    each task; an empty ledger gives zeros.
    """
    cells = [(p, rule) for p in policies for rule in p.rules]
    count = lambda test: F.coalesce(F.sum(F.when(test, 1).otherwise(0)), F.lit(0))
    failed = lambda mask: F.col("failures").bitwiseAND(F.lit(mask))
    sums = [F.count(F.lit(1)).alias("documents")]
    for k, (p, rule) in enumerate(cells):
        sums += [
            count(failed(p.mask) != 0).alias(f"r{k}"),
            count(failed(RULES[rule]) != 0).alias(f"f{k}"),
            count(failed(p.mask) == RULES[rule]).alias(f"o{k}"),
        ]
    rows_out = [
        F.struct(
            F.lit(p.name).alias("policy"),
            F.lit(p.version).alias("policy_version"),
            F.lit(rule).alias("rule"),
            F.col("documents").alias("documents"),
            F.col(f"r{k}").cast("long").alias("rejected"),
            F.col(f"f{k}").cast("long").alias("failed"),
            F.col(f"o{k}").cast("long").alias("only_this"),
        )
        for k, (p, rule) in enumerate(cells)
    ]
    return rows.agg(*sums).select(F.inline(F.array(*rows_out)))


def keep_good(docs: DataFrame, policy: Policy = PROSE, text: str = "text") -> DataFrame:
    """The documents that pass, with their own columns only."""
    inside = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(inside.alias("_row"), F.col(f"`{text}`").alias("_text"))
    judged = ledger(rows, "_text", ("_row",))
    # A filter isn't moved below a generator; moved below the ledger it would repeat every measurement.
    judged = judged.select("_row", F.explode(F.array("failures")).alias("failures"))
    return judged.where(passes(policy)).select("_row.*")
