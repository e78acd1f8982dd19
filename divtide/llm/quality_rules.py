"""Quality rules as a ledger of failure bits and measurements.

`measure` reads each text once, `ledger` turns the measurements into one bit per rule, and everything after
that works on bits: a policy is a mask with a tolerance, and `ablations` asks what each rule does to a policy
by counting bit patterns. Policies can thus change without reading a text again.

Defined cases: a NULL or empty text has no words, lines or symbols, so it fails `few_words` only. A NULL
doc_id is carried like any other. Repeated rows are judged one by one. Other columns of the input are ignored
by `ledger`, whatever their names.
"""

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from divtide.llm.common import NOT_SPACE, whole_text, words

SYMBOLS = r"[#*$%&|<>]"


@dataclass(frozen=True)
class Rule:
    name: str
    fails: str  # a condition over the measurements, in whole numbers only


# A rule's place in this list is its bit; new rules go to the end.
RULES = (
    Rule("few_words", "n_words < 50"),
    Rule("repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    Rule("symbols", "100 * n_symbols > 25 * n_words"),
    Rule("capitals", "n_letters > 0 and 100 * n_capitals > 40 * n_letters"),
    Rule("exclamations", "100 * n_exclamations > 30 * n_words"),
    Rule("duplicate_lines", "n_lines >= 4 and 100 * n_dup_lines > 50 * n_lines"),
    Rule("long_words", "word_chars > 20 * n_words"),
    Rule("few_letters", "2 * n_letters < word_chars"),
)
BIT = {rule.name: 1 << place for place, rule in enumerate(RULES)}


@dataclass(frozen=True)
class Policy:
    """A document is rejected if it fails any `hard` rule or more than `tolerance` of the `soft` ones."""

    hard: tuple[str, ...]
    soft: tuple[str, ...] = ()
    tolerance: int = 0

    @property
    def hard_mask(self) -> int:
        return sum(BIT[name] for name in self.hard)

    @property
    def soft_mask(self) -> int:
        return sum(BIT[name] for name in self.soft)


BASE = ("few_words", "repeated_windows")
# Old versions stay, so that a ledger can be judged again as it was.
POLICIES = {
    "v1": Policy(hard=BASE),
    "v2": Policy(hard=(*BASE, "symbols", "capitals"), soft=("exclamations", "duplicate_lines", "long_words", "few_letters"), tolerance=0),
}
CURRENT = "v2"


def matches(text: Column, pattern: str) -> Column:
    """How often the one-character pattern occurs."""
    return F.char_length(text) - F.char_length(F.regexp_replace(text, pattern, ""))


def repeat_words(tokens: Column, size: int = 3) -> Column:
    """Words in windows of `size` words that the array holds twice or more.

    The windows are sorted within the row, so that equal ones are neighbours: n log n for any text.
    """
    n = F.size(tokens)
    starts = F.sequence(F.lit(0), n - size)
    window = F.transform(
        starts,
        lambda i: F.struct(F.concat_ws(" ", *[F.get(tokens, i + k) for k in range(size)]).alias("window"), i.alias("at")),
    )
    # `transform` over a one-element array names the sorted windows, so that they are computed once.
    places = F.flatten(
        F.transform(
            F.array(F.sort_array(window)),
            lambda s: F.transform(
                F.filter(
                    s,
                    lambda x, j: F.coalesce(x["window"] == F.get(s, j - 1)["window"], F.lit(False))
                    | F.coalesce(x["window"] == F.get(s, j + 1)["window"], F.lit(False)),
                ),
                lambda x: x["at"],
            ),
        )
    )
    covered = F.aggregate(
        F.sort_array(places),
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(-size).alias("last")),
        lambda acc, at: F.struct((acc["n"] + F.least(F.lit(size), at - acc["last"])).alias("n"), at.alias("last")),
        lambda acc: acc["n"],
    )
    return F.when(n < size, F.lit(0).cast("long")).otherwise(covered)


def measure(docs: DataFrame) -> DataFrame:
    """doc_id and the measurements that the rules are stated over."""
    text = F.col("text")
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(NOT_SPACE))
    split = docs.select("doc_id", whole_text("text").alias("text")).select(
        "doc_id", "text", words(text).alias("words"), lines.alias("lines")
    )
    measures = {
        "n_words": F.size("words"),
        "word_chars": F.char_length(F.array_join("words", "")),
        "n_symbols": matches(text, SYMBOLS),
        "n_dup_lines": F.size("lines") - F.size(F.array_distinct("lines")),
        "n_repeat_words": repeat_words(F.col("words")),
        "n_lines": F.size("lines"),
        "n_letters": matches(text, r"\p{L}"),
        "n_capitals": matches(text, r"\p{Lu}"),
        "n_exclamations": matches(text, "!"),
    }
    # Generating the one row keeps the optimiser from copying these expressions into a later filter, where they
    # would be computed again for each rule and the words split again for each window.
    row = F.struct(*[value.cast("long").alias(name) for name, value in measures.items()])
    return split.select("doc_id", F.inline(F.array(row)))


def ledger(docs: DataFrame) -> DataFrame:
    """doc_id, the measurements, and `fail_bits`: bit i is set if rule i fails. Every rule is evaluated once."""
    bits = [F.when(F.expr(rule.fails), F.lit(BIT[rule.name])).otherwise(0).cast("long") for rule in RULES]
    return measure(docs).withColumn("fail_bits", reduce(Column.bitwiseOR, bits))


def passes(policy: Policy, bits: Column | None = None) -> Column:
    """Whether a row with these failure bits is kept."""
    bits = F.col("fail_bits") if bits is None else bits
    soft = F.bit_count(bits.bitwiseAND(F.lit(policy.soft_mask).cast("long")))
    return (bits.bitwiseAND(F.lit(policy.hard_mask).cast("long")) == 0) & (soft <= policy.tolerance)


def judge(book: DataFrame, version: str = CURRENT) -> DataFrame:
    """The ledger with the verdict of one policy: `policy`, `base_failed`, `kept`."""
    base = F.col("fail_bits").bitwiseAND(F.lit(POLICIES["v1"].hard_mask).cast("long")) != 0
    return book.withColumns({"policy": F.lit(version), "base_failed": base, "kept": ~base & passes(POLICIES[version])})


def ablations(book: DataFrame, version: str = CURRENT) -> DataFrame:
    """Per rule of a policy: documents that fail it, and documents kept with it and without it.

    Rows are first counted by bit pattern, of which there are at most 2 to the number of rules.
    """
    policy = POLICIES[version]
    patterns = book.groupBy("fail_bits").agg(F.count("*").alias("n"))
    names = [*policy.hard, *policy.soft]
    bits = F.col("fail_bits")

    def total(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0).cast("long"))

    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("rule"),
                total(bits.bitwiseAND(F.lit(BIT[name]).cast("long")) != 0).alias("failing"),
                total(passes(policy)).alias("kept"),
                total(passes(policy, bits.bitwiseAND(F.lit(~BIT[name]).cast("long")))).alias("kept_without"),
            )
            for name in names
        ]
    )
    return patterns.agg(rows.alias("rows")).select(F.inline("rows"))


def keep_good(docs: DataFrame, version: str = CURRENT) -> DataFrame:
    """The documents that a policy keeps, all their columns; measures each row beside its own columns.

    The text is the only column that the rules read, so rows carry their own verdict and need no join.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    carried = docs.select(row.alias("doc_id"), "text")
    good = judge(ledger(carried), version).where("kept")
    return good.select(*[F.col("doc_id").getField(c).alias(c) for c in docs.columns])
