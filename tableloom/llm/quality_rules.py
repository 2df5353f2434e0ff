"""Quality rules with a verdict on whole hosts, in DataFrame functions only.

Each document is measured once. Failures of every rule are summed by host, the host's rates are
shrunk towards the rates of all hosts by a beta prior fitted to them, and a host whose shrunk rate
passes the limit for some rule loses all its documents. Sums combine before the shuffle, so a host with a
third of the documents costs one row per task, and texts are never shuffled.

Defined cases: a null or empty text has no words (and fails the base rules); a document without
host is judged by its own rules alone; repeated rows are measured and counted one by one; an empty
table gives an empty table. Columns of the input that clash with a measure are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableloom.llm.common import text_or_empty, written

SPACE = r"[\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\f\r"
SYMBOLS = r"[#*$%&|<>]+"

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_SYMBOLS_PER_100_WORDS = 20
MAX_DUP_LINE_PERCENT = 50
WORD_LENGTH = (2, 20)
MAX_HOST_RATE = 0.5
MAX_PRIOR_ROWS = 1e9

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def measure_texts(docs: DataFrame, text: str, *carried: Column) -> DataFrame:
    """The carried columns with the measures of each text.

    Repeated three-word windows are found by sorting numbers that hold a window's hash above its
    position: windows of equal hash become neighbours, and their words are compared. Should different
    windows share a hash, the text's windows are sorted by their words instead. The steps are separate
    projections, so each array is computed once per row.
    """
    trimmed = F.btrim(F.col("_text"), F.lit(BLANKS))
    lines = F.filter(F.split("_text", "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    names = [f"_c{i}" for i in range(len(carried))]
    first = docs.select(*[c.alias(n) for c, n in zip(carried, names)], text_or_empty(text).alias("_text"))
    split = first.select(
        *names, F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE)).alias("_words"),
        (F.octet_length("_text") - F.octet_length(F.regexp_replace("_text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        lines.alias("_lines"),
    )
    bits = F.length(F.bin(F.size("_words")))
    keys = F.transform(_starts("_words"), lambda i: F.call_function(
        "shiftleft", window_hash(*_window("_words", i)), F.length(F.bin(F.size("_words")))).bitwiseOR(i))
    sized = split.select(
        *names, "_words", "n_symbols", F.size("_words").cast("long").alias("n_words"), bits.alias("_bits"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.sort_array(keys).alias("_keys"),
    )
    kept = [*names, *MEASURES[:4], "n_lines"]
    found = sized.select(*kept, "_words", _alike("_keys").alias("_at"), _differing("_keys").alias("_differ"))
    positions = F.when(F.col("_differ"), _repeated_by_words("_words")).otherwise(F.col("_at"))
    placed = found.select(*kept, F.sort_array(positions).alias("_at"))
    covered = F.aggregate(
        "_at", F.struct(F.lit(-3).cast("long").alias("last"), F.lit(0).cast("long").alias("total")),
        lambda a, p: F.struct(
            p.alias("last"), (a.getField("total") + F.least(F.lit(3).cast("long"), p - a.getField("last"))).alias("total")
        ),
        lambda a: a.getField("total"),
    )
    return placed.select(*kept, covered.alias("n_repeat_words"))


def window_hash(*words: Column) -> Column:
    return F.xxhash64(*words)


def _starts(words: str) -> Column:
    """The windows' first words; texts of fewer than three have one incomplete window."""
    return F.sequence(F.lit(0).cast("long"), F.greatest(F.size(words) - 3, F.lit(0)).cast("long"))


def _window(words: str, i: Column) -> list[Column]:
    at = i.cast("int")
    return [F.get(F.col(words), at), F.get(F.col(words), at + 1), F.get(F.col(words), at + 2)]


def _hash_part(key: Column) -> Column:
    return F.call_function("shiftrightunsigned", key, F.col("_bits"))


def _position(key: Column) -> Column:
    return key.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("_bits")) - 1)


def _alike(keys: str) -> Column:
    """Positions of the windows whose hash a neighbour in the sorted keys shares."""
    def shared(x: Column, i: Column) -> Column:
        return (_hash_part(F.get(F.col(keys), i - 1)) == _hash_part(x)) | (_hash_part(F.get(F.col(keys), i + 1)) == _hash_part(x))

    return F.transform(F.filter(keys, shared), _position)


def _differing(keys: str) -> Column:
    """Whether neighbours of one hash are different windows."""
    def clash(x: Column, i: Column) -> Column:
        before = F.get(F.col(keys), i - 1)
        pairs = zip(_window("_words", _position(x)), _window("_words", _position(before)))
        return (_hash_part(before) == _hash_part(x)) & ~_all([a == b for a, b in pairs])

    return F.size(F.filter(keys, clash)) > 0


def _all(conditions: list[Column]) -> Column:
    result = conditions[0]
    for c in conditions[1:]:
        result = result & c
    return result


def _repeated_by_words(words: str) -> Column:
    """Positions of the windows that occur twice or more, by sorting the windows themselves."""
    windows = F.sort_array(F.transform(_starts(words), lambda i: F.struct(
        F.concat_ws(" ", *_window(words, i)).alias("g"), i.alias("p"))))

    def repeated(near: Column) -> Column:
        def twin(x: Column, i: Column) -> Column:
            before, after = F.get(near, i - 1).getField("g"), F.get(near, i + 1).getField("g")
            return (before == x.getField("g")) | (after == x.getField("g"))

        return F.transform(F.filter(near, twin), lambda x: x.getField("p"))

    # A transform over one element binds the sorted windows, which would else be sorted once per window.
    return F.get(F.transform(F.array(windows), repeated), F.lit(0))


def rule_failures() -> dict[str, Column]:
    """Each rule as a boolean over the measures; the first two are the base rules."""
    words, chars = F.col("n_words"), F.col("word_chars")
    return {
        "few_words": words < MIN_WORDS,
        "repetitive": 100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * words,
        "symbols": 100 * F.col("n_symbols") > MAX_SYMBOLS_PER_100_WORDS * words,
        "dup_lines": 100 * F.col("n_dup_lines") > MAX_DUP_LINE_PERCENT * F.col("n_lines"),
        "word_length": (chars < WORD_LENGTH[0] * words) | (chars > WORD_LENGTH[1] * words),
    }


def host_verdicts(failures: DataFrame, host: str, rules: list[str]) -> DataFrame:
    """Per host: rows, and per rule the failures' rate shrunk by the fitted beta prior.

    The prior's mean is the rate over all rows. Its weight comes from the spread of the hosts' rates
    beyond what binomial chance explains; without such spread hosts are shrunk to the mean. The
    prior is one row, computed by an aggregate over the hosts' sums.
    """
    sums = written(
        failures.where(F.col(host).isNotNull()).groupBy(host).agg(
            F.count(F.lit(1)).alias("n_docs"), *[F.sum(F.col(r).cast("long")).alias(r) for r in rules]
        ), "hosts")
    totals = sums.agg(
        F.sum("n_docs").alias("_n"), F.count(F.lit(1)).alias("_hosts"),
        F.sum(F.col("n_docs") * F.col("n_docs")).alias("_nn"),
        *[F.sum(r).alias(f"_f_{r}") for r in rules],
        *[F.sum(F.col(r) * F.col(r) / F.col("n_docs")).alias(f"_q_{r}") for r in rules],
    ).first()
    n, hosts = totals["_n"] or 0, totals["_hosts"]
    rates = []
    for r in rules:
        mean = (totals[f"_f_{r}"] or 0) / n if n else 0.0
        spread = (totals[f"_q_{r}"] or 0.0) - n * mean * mean
        chance = (hosts - 1) * mean * (1 - mean)
        scale = n - totals["_nn"] / n if n else 0.0
        between = max(0.0, (spread - chance) / scale) if scale > 0 else 0.0
        weight = MAX_PRIOR_ROWS if between <= 0 else min(MAX_PRIOR_ROWS, max(0.0, mean * (1 - mean) / between - 1))
        rates.append(((F.col(r) + mean * weight) / (F.col("n_docs") + weight)).alias(f"rate_{r}"))
    return sums.select(host, "n_docs", *rates)


def judge(docs: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source",
          max_host_rate: float = MAX_HOST_RATE) -> DataFrame:
    """Per row: key, host, the measures, ``base_failed``, ``host_failed`` and ``kept``."""
    rules = rule_failures()
    measured = measure_texts(docs, text, F.col(key), F.col(host)).withColumnsRenamed({"_c0": "_key", "_c1": "_host"})
    rows = written(measured, "measures").withColumns({f"_r_{r}": c for r, c in rules.items()})
    names = [f"_r_{r}" for r in rules]
    verdicts = host_verdicts(rows, "_host", names)
    failed = F.greatest(*[F.col(f"rate_{n}") for n in names], F.lit(0.0)) > max_host_rate
    bad = written(verdicts.where(failed).select(F.col("_host").alias("_bad")), "bad-hosts")
    base = F.col("_r_few_words") | F.col("_r_repetitive")
    return rows.join(bad, F.col("_host") == F.col("_bad"), "left").select(
        F.col("_key").alias(key), F.col("_host").alias(host), *MEASURES, base.alias("base_failed"),
        F.col("_bad").isNotNull().alias("host_failed"), (~base & F.col("_bad").isNull()).alias("kept"),
    )
