"""Validation rules as columns, and the split into valid and quarantined rows."""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyline.functions.parsing import integer, is_uuid, moment, number, numeric, scaled

# The columns of a record, in order, and the domains.
COLUMNS = ["bet_id", "customer_id", "bet_datetime", "bet_num", "betting_amount", "price", "category", "stake_type", "bet_result", "payout", "return_for_entain"]
MONEY = ["betting_amount", "price", "payout", "return_for_entain"]
CATEGORIES = ("sports", "racing")
STAKES = ("cash", "bonus")
RESULTS = ("return", "no-return")
RAW_SCHEMA = ", ".join([*(f"{c} string" for c in COLUMNS), "source_row_number bigint"])
VALID_TYPES = {"bet_id": "bigint", "customer_id": "string", "bet_datetime": "timestamp_ntz", "bet_num": "bigint", "betting_amount": "double", "price": "double", "category": "string", "stake_type": "string", "bet_result": "string", "payout": "double", "return_for_entain": "double", "source_row_number": "bigint"}


@dataclass(frozen=True)
class RuleConfig:
    categories: tuple[str, ...] = CATEGORIES
    stakes: tuple[str, ...] = STAKES
    results: tuple[str, ...] = RESULTS
    tolerance: Decimal = Decimal("0.00001")
    #: Columns that a source must have and that must not be empty.
    columns: tuple[str, ...] = tuple(COLUMNS)


def project(raw: DataFrame) -> DataFrame:
    """The expected columns as text (absent and null: empty) and ``source_row_number``."""
    return raw.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) if c in raw.columns else F.lit("").alias(c) for c in COLUMNS), "source_row_number")


def _parsed(rows: DataFrame) -> DataFrame:
    return rows.withColumns({"p_id": integer(F.col("bet_id")), "p_num": integer(F.col("bet_num")), "p_ts": moment(F.col("bet_datetime"))} | {f"p_{c}": number(F.col(c)) for c in MONEY} | {f"d_{c}": F.when(numeric(F.col(c)), F.trim(c).try_cast("double")) for c in MONEY})


# formulas as SQL, as one text is far cheaper to build than hundreds of columns
_CASES = {"lost": "bet_result = 'no-return'", "won_cash": "bet_result = 'return' AND stake_type = 'cash'", "won_bonus": "bet_result = 'return' AND stake_type = 'bonus'", "lost_cash": "bet_result = 'no-return' AND stake_type = 'cash'", "lost_bonus": "bet_result = 'no-return' AND stake_type = 'bonus'"}
_SCALED = "named_struct('digits', CAST({} AS DECIMAL(38,0)), 'scale', CAST({} AS INT))"


def _cases(**values: str) -> str:
    return "CASE " + " ".join(f"WHEN {_CASES[case]} THEN {value}" for case, value in values.items()) + " END"


def _power(exponent: str) -> str:
    """10 to a whole exponent of 0 or more; null beyond 38 digits."""
    return f"CASE WHEN {exponent} BETWEEN 0 AND 37 THEN try_cast(rpad('1', {exponent} + 1, '0') AS DECIMAL(38,0)) END"


def _digits(value: str, scale: str) -> str:
    """The digits of a struct as ``scaled`` makes it at a scale that is not smaller."""
    return f"try_multiply({value}.digits, {_power(f'({scale} - {value}.scale)')})"


def _expected(rows: DataFrame) -> DataFrame:
    """Payout and return by the formulas, as decimals ``e_*`` and doubles ``f_*`` (null: no formula applies).

    Rows with a number that the decimals don't hold have ``x_*`` instead, digits with a scale, as ``scaled``
    makes them; a value of more than 38 digits is null there, and the doubles count.
    """
    long = " OR ".join(f"p_{x} IS NULL" for x in MONEY)
    rows = rows.withColumns({f"s_{x}": F.when(F.expr(long), scaled(F.col(x))) for x in MONEY})
    out = {}
    for kind, to, form in (("p", "e", "CAST({} AS DECIMAL(38,16))"), ("d", "f", "CAST({} AS DOUBLE)")):
        a, q, o, put = f"{kind}_betting_amount", f"{kind}_price", f"{kind}_payout", form.format
        out[f"{to}_payout"] = _cases(lost=put("0"), won_cash=put(f"{a} * {q}"), won_bonus=put(f"{a} * ({q} - 1)"))
        out[f"{to}_return_for_entain"] = _cases(lost_cash=put(a), lost_bonus=put("0"), won_cash=put(f"{a} - {o}"), won_bonus=put(f"-{o}"))
    a, q, o, put = "s_betting_amount", "s_price", "s_payout", _SCALED.format
    both, wide = f"{a}.scale + {q}.scale", f"greatest({a}.scale, {o}.scale)"
    less = f"try_subtract({q}.digits, {_power(f'{q}.scale')})"
    made = _cases(lost=put("0", "0"), won_cash=put(f"try_multiply({a}.digits, {q}.digits)", both), won_bonus=put(f"try_multiply({a}.digits, {less})", both))
    left = _cases(lost_cash=a, lost_bonus=put("0", "0"), won_cash=put(f"try_subtract({_digits(a, wide)}, {_digits(o, wide)})", wide), won_bonus=put(f"-{o}.digits", f"{o}.scale"))
    out |= {"x_payout": f"CASE WHEN {long} THEN {made} END", "x_return_for_entain": f"CASE WHEN {long} THEN {left} END"}
    return rows.selectExpr("*", *(f"{value} AS {name}" for name, value in out.items()))


def _off(x: str, tolerance: Decimal) -> str:
    """Whether ``x`` is off its formula by more than the tolerance: by decimals, by digits, else by doubles."""
    places = max(0, -tolerance.as_tuple().exponent)
    scale = f"greatest(s_{x}.scale, x_{x}.scale, {places})"
    limit = f"try_multiply({int(tolerance.scaleb(places))}BD, {_power(f'({scale} - {places})')})"
    digits = f"abs(try_subtract({_digits(f's_{x}', scale)}, {_digits(f'x_{x}', scale)})) > {limit}"
    exact = f"abs(CAST(p_{x} AS DECIMAL(38,16)) - e_{x}) > {tolerance:f}BD"
    return f"coalesce({exact}, {digits}, abs(d_{x} - f_{x}) > {float(tolerance)}D)"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def row_errors(missing: list[str], cfg: RuleConfig, library: bool) -> list[tuple[str, str]]:
    """(rule, condition in SQL) of the rules that look at one row; ``_expected`` has made their columns."""
    out = [(f"missing_column:{x}", "true") for x in missing]
    out += [(f"missing_value:{x}", f"{x} = ''") for x in cfg.columns if not (library and x in missing)]
    out += [("bet_id_integer", "p_id IS NULL"), ("customer_id_uuid", "NOT is_id"), ("bet_datetime_parseable", "p_ts IS NULL"), ("bet_num_integer", "p_num IS NULL"), ("bet_num_positive", "p_num < 1")]
    out += [(f"{x}_numeric", f"d_{x} IS NULL") for x in MONEY]
    out += [("betting_amount_gt_0", "d_betting_amount <= 0"), ("price_gt_1", "d_price <= 1")]
    out += [(f"{x}_domain", f"NOT array_contains(array({', '.join(map(_text, allowed))}), {x})") for x, allowed in (("category", cfg.categories), ("stake_type", cfg.stakes), ("bet_result", cfg.results))]
    if not (library and {"stake_type", "bet_result"} & set(missing)):
        for x, needs in (("payout", ("betting_amount", "price", "payout")), ("return_for_entain", ("betting_amount", "payout", "return_for_entain"))):
            ready = " AND ".join(f"d_{y} IS NOT NULL" for y in needs)
            out += [(f"{x}_rule_not_evaluable", f"{ready} AND f_{x} IS NULL"), (f"{x}_formula", f"{ready} AND f_{x} IS NOT NULL AND {_off(x, cfg.tolerance)}")]
    return out


def first_rows(rows: DataFrame) -> DataFrame:
    """Repeated, non-empty bet ids with their first source row."""
    return rows.where("bet_id <> ''").groupBy("bet_id").agg(F.min("source_row_number").alias("first_row"), F.count(F.lit(1)).alias("occurrences")).where("occurrences > 1")


def gaps(rows: DataFrame) -> DataFrame:
    """Customers whose distinct positive bet numbers aren't 1 to their largest (``p_num`` is parsed)."""
    seen = rows.where("customer_id <> '' AND p_num > 0").groupBy("customer_id").agg(F.countDistinct("p_num").alias("distinct_nums"), F.max("p_num").alias("last_num"))
    return seen.where("distinct_nums <> last_num")


def _names(checks: list[tuple[str, str]]) -> Column:
    return F.expr(f"array_compact(array({', '.join(f'CASE WHEN {when} THEN {_text(rule)} END' for rule, when in checks)}))")


def _customer_facts(rows: DataFrame, library: bool) -> DataFrame:
    """``turn`` of a row among those of its customer and number, and the customer's numbers.

    One shuffle by customer serves all windows. Rows that no rule across rows can flag are spread
    by their row number, so that empty customers or numbers don't meet in one task.
    """
    counted = F.col("p_num").isNotNull() if library else F.col("p_num").isNotNull() & (F.col("customer_id") != "")
    whole = ["w_customer", "w_row"]
    rows = rows.withColumns({"w_customer": F.when(counted, F.col("customer_id")), "w_row": F.when(~counted, F.col("source_row_number"))}).repartition(*whole)
    same, customer = Window.partitionBy(*whole, "p_num").orderBy("source_row_number"), Window.partitionBy(*whole)
    rows = rows.withColumn("turn", F.row_number().over(same))
    if library:
        rows = rows.withColumn("twins", F.count(F.lit(1)).over(Window.partitionBy(*whole, "bet_num")))
    used = F.lit(True) if library else F.col("p_num") > 0
    return rows.withColumns({"nums": F.count_if((F.col("turn") == 1) & used).over(customer), "least_num": F.min("p_num").over(customer), "last_num": F.max("p_num").over(customer)}).drop(*whole)


def annotate(raw: DataFrame, cfg: RuleConfig = RuleConfig(), mode: str = "batch", columns: list[str] | None = None) -> DataFrame:
    """Rows with parsed columns and ``errors``, the sorted names of the rules that each breaks.

    ``batch`` flags later copies of a bet id or customer and number, and whole customers with a gap;
    ``library`` flags all copies and takes the first of its number rules only. Rows move once, by
    customer; besides, only the ids that repeat are joined back. ``columns`` names those that the
    source had, where ``raw`` is already filled up.
    """
    library = mode == "library"
    missing = [x for x in cfg.columns if x not in (raw.columns if columns is None else columns)]
    rows = _parsed(project(raw))
    # before the shuffle, so that the rules of one row are looked at once whatever becomes of the rows
    found = _expected(rows.withColumn("is_id", is_uuid(F.col("customer_id")))).withColumn("own", _names(row_errors(missing, cfg, library)))
    moved = _customer_facts(found.select(*COLUMNS, "source_row_number", "p_id", "p_num", "p_ts", *(f"d_{x}" for x in MONEY), "own"), library)
    rows = moved.join(first_rows(rows).select("bet_id", "first_row"), "bet_id", "left")
    if library:
        gap = "(nums <> last_num OR least_num < 1)"
        checks = [("bet_id_unique", "first_row IS NOT NULL AND p_id IS NOT NULL"), ("customer_bet_num_unique", "p_num >= 1 AND twins > 1"), ("customer_bet_num_sequence", f"p_num >= 1 AND twins <= 1 AND bet_num = CAST(p_num AS STRING) AND {gap}")]
    else:
        checks = [("bet_id_unique", "first_row <> source_row_number"), ("customer_bet_num_unique", "customer_id <> '' AND p_num IS NOT NULL AND turn > 1"), ("customer_bet_num_sequence", "customer_id <> '' AND p_num > 0 AND nums <> last_num")]
    return rows.withColumn("errors", F.array_sort(F.array_distinct(F.concat("own", _names(checks))))).drop("own")


def valid(annotated: DataFrame) -> DataFrame:
    typed = [F.col("p_id").alias("bet_id"), "customer_id", F.col("p_ts").alias("bet_datetime"), F.col("p_num").alias("bet_num"), *(F.col(f"d_{c}").alias(c) for c in MONEY[:2]), "category", "stake_type", "bet_result", *(F.col(f"d_{c}").alias(c) for c in MONEY[2:]), "source_row_number"]
    return annotated.where(F.size("errors") == 0).select(*typed)


def invalid(annotated: DataFrame, columns: tuple[str, ...] = tuple(COLUMNS)) -> DataFrame:
    return annotated.where(F.size("errors") > 0).select(*columns, "source_row_number", F.array_join("errors", "|").alias("validation_errors"))


def failure_counts(annotated: DataFrame) -> DataFrame:
    return annotated.select(F.explode("errors").alias("rule")).groupBy("rule").agg(F.count(F.lit(1)).alias("failures"))


def totals(annotated: DataFrame) -> DataFrame:
    return annotated.agg(F.count(F.lit(1)).alias("total_rows"), F.count_if(F.size("errors") == 0).alias("valid_rows"), F.count_if(F.size("errors") > 0).alias("invalid_rows"))
