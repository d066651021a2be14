"""Queries for validation rules and the account ledger (V, A16, A17)."""

from pyspark.sql import functions as F

from millrace.operators import joins, ledger, rules
from millrace.plans.registry import joined, query, table

# -- rules --------------------------------------------------------------------


def _checked(df, rule, *columns):
    out = rules.validate(df, rule)
    return out.select(*columns, "valid", joined("valid_values").alias("valid_values"), joined("errors", "; ").alias("errors"))


def _rule_sql(source: str, columns: str, ok: str, value: str, name: str) -> str:
    return f"""
    SELECT {columns}, {ok} AS valid, CASE WHEN {ok} THEN coalesce(CAST({value} AS VARCHAR), '') ELSE '' END AS valid_values,
           CASE WHEN {ok} THEN '' ELSE '{name} failed' END AS errors FROM {source}
    """


@query("v01_unique_product", _rule_sql("part", "p_partkey", "p_name NOT IN ('small ring', 'red widget')", "p_name", "uniqueProductName"))
def _(spark, sf):
    return _checked(table(spark, sf, "part"), rules.unique_product("p_name", ["small ring", "red widget"]), "p_partkey")


@query("v01_known_spec_map", _rule_sql("part", "p_partkey", "p_size IN (1, 5, 9, 13)", "p_size", "knownSpecMap"))
def _(spark, sf):
    return _checked(table(spark, sf, "part"), rules.known_spec_map("p_size", {1: "a", 5: "b", 9: "c", 13: "d"}), "p_partkey")


@query(
    "v01_known_in_large_set",
    _rule_sql(
        "lineitem",
        "l_orderkey, l_linenumber, l_partkey",
        "l_partkey IN (SELECT p_partkey FROM part WHERE p_size < 30)",
        "l_partkey",
        "knownProductName",
    ),
)
def _(spark, sf):
    known = table(spark, sf, "part").where("p_size < 30").select("p_partkey")
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    flagged = joins.flag_member(lines, "l_partkey", known, "known")
    return _checked(flagged, rules.flagged("l_partkey", "known", "knownProductName"), "l_orderkey", "l_linenumber", "l_partkey")


_SIZE = "CASE WHEN p_size % 3 > 0 THEN p_size END"


@query(
    "v02_optional",
    f"""
    SELECT p_partkey, s IS NULL OR s IN (1, 2, 4, 5) AS valid,
           CASE WHEN s IN (1, 2, 4, 5) THEN CAST(s AS VARCHAR) ELSE '' END AS valid_values,
           CASE WHEN s IS NULL OR s IN (1, 2, 4, 5) THEN '' ELSE 'knownProductOpt failed' END AS errors
    FROM (SELECT p_partkey, {_SIZE} AS s FROM part)
    """,
)
def _(spark, sf):
    df = table(spark, sf, "part").withColumn("s", F.expr(_SIZE))
    return _checked(df, rules.known_product_optional("s", {1: "a", 2: "b", 4: "c", 5: "d"}), "p_partkey")


_FLAGS = """
    (SELECT *, p_brand NOT IN ('Brand#1', 'Brand#2', 'Brand#3') AS a, p_type IN ('ECONOMY', 'PROMO') AS b,
            p_size NOT IN (1, 2, 3, 4, 6) AS c FROM part)
"""


@query(
    "v03_and",
    f"""
    SELECT p_partkey, a AND b AS valid, CASE WHEN a AND b THEN concat(p_brand, ',', p_type) ELSE '' END AS valid_values,
           concat_ws('; ', CASE WHEN NOT a THEN 'uniqueProductName failed' END, CASE WHEN NOT b THEN 'knownSpecSet failed' END) AS errors
    FROM {_FLAGS}
    """,
)
def _(spark, sf):
    rule = rules.unique_product("p_brand", ["Brand#1", "Brand#2", "Brand#3"]) & rules.known_spec("p_type", ["ECONOMY", "PROMO"])
    return _checked(table(spark, sf, "part"), rule, "p_partkey")


@query(
    "v04_or",
    f"""
    SELECT p_partkey, a OR b AS valid, concat_ws(',', CASE WHEN a THEN p_brand END, CASE WHEN b THEN p_type END) AS valid_values,
           CASE WHEN a OR b THEN '' ELSE 'uniqueProductName failed; knownSpecSet failed' END AS errors
    FROM {_FLAGS}
    """,
)
def _(spark, sf):
    rule = rules.unique_product("p_brand", ["Brand#1", "Brand#2", "Brand#3"]) | rules.known_spec("p_type", ["ECONOMY", "PROMO"])
    return _checked(table(spark, sf, "part"), rule, "p_partkey")


@query(
    "v05_named_rules",
    f"""
    SELECT p_partkey, (a OR b) AND c AS valid,
           CASE WHEN (a OR b) AND c
                THEN concat_ws(',', CASE WHEN a THEN p_brand END, CASE WHEN b THEN p_type END, CAST(p_size AS VARCHAR)) ELSE '' END AS valid_values,
           concat_ws('; ', CASE WHEN NOT a AND NOT b THEN 'uniqueProductName failed; knownSpecMap failed' END,
                           CASE WHEN NOT c THEN 'uniqueSpec failed' END) AS errors
    FROM {_FLAGS}
    """,
)
def _(spark, sf):
    rule = (
        rules.unique_product("p_brand", ["Brand#1", "Brand#2", "Brand#3"])
        | rules.known_spec_map("p_type", {"ECONOMY": 1, "PROMO": 2})
    ) & rules.unique_spec("p_size", [1, 2, 3, 4, 6])
    return _checked(table(spark, sf, "part"), rule, "p_partkey")


# -- ledger: customers open accounts, orders move money -------------------------

_OPS = [
    """
    SELECT CAST(c_custkey AS BIGINT) AS seq, 'open' AS op, concat('ACC', c_custkey) AS no, CAST(NULL AS STRING) AS to_no,
           CASE WHEN c_custkey % 3 = 0 THEN 'savings' ELSE 'checking' END AS type,
           CAST(CASE c_custkey % 5 WHEN 0 THEN 0.0 WHEN 1 THEN NULL ELSE 2.5 END AS DECIMAL(5,2)) AS rate,
           CAST(0 AS BIGINT) AS amount, DATE '1992-01-01' AS op_date,
           CASE WHEN c_custkey % 2 = 0 THEN DATE '1992-02-01' END AS open_date,
           CASE WHEN c_custkey % 11 = 0 THEN DATE '1992-01-15' END AS close_date
    FROM customer
    """,
    """
    SELECT CAST({day} AS BIGINT) * 1099511627776 + o_orderkey AS seq,
           CASE WHEN o_orderkey % 100 = 0 THEN 'open' WHEN o_orderkey % 10 < 5 THEN 'credit'
                WHEN o_orderkey % 10 = 8 THEN 'transfer' WHEN o_orderkey % 50 = 49 THEN 'close' ELSE 'debit' END AS op,
           concat('ACC', o_custkey) AS no,
           CASE WHEN o_orderkey % 10 = 8 THEN concat('ACC', o_custkey + 1) END AS to_no,
           'checking' AS type, CAST(NULL AS DECIMAL(5,2)) AS rate,
           CAST(round(o_totalprice * 100) AS BIGINT) AS amount, CAST(o_orderdate AS DATE) AS op_date,
           CAST(NULL AS DATE) AS open_date, CAST(NULL AS DATE) AS close_date
    FROM orders
    """,
]


def _ops(spark, sf):
    customer, orders = table(spark, sf, "customer"), table(spark, sf, "orders")
    openings = spark.sql(_OPS[0].replace("FROM customer", "FROM {t}"), t=customer)
    moves = spark.sql(_OPS[1].replace("{day}", "unix_date(CAST(o_orderdate AS DATE))").replace("FROM orders", "FROM {t}"), t=orders)
    return openings.unionByName(moves)


_DUCK_OPS = (
    " UNION ALL ".join(_OPS).replace("{day}", "(CAST(o_orderdate AS DATE) - DATE '1970-01-01')").replace("AS STRING", "AS VARCHAR")
)

_OPENING_ERRORS = """
    CASE WHEN type = 'savings' AND rate IS NULL THEN 'Rate needs to be given for savings account'
         ELSE concat_ws('; ',
            CASE WHEN length(no) < 5 THEN concat('Account No has to be at least 5 characters long: found ', no) END,
            CASE WHEN close_date < coalesce(open_date, op_date)
                 THEN concat('Close date [', close_date, '] cannot be earlier than open date [', coalesce(open_date, op_date), ']') END,
            CASE WHEN type = 'savings' AND rate <= 0 THEN concat('Interest rate ', rate, ' must be > 0') END) END
"""

# One recursive step per operation of an account.
_LEDGER = f"""
    WITH RECURSIVE ops AS ({_DUCK_OPS}),
    legs AS (SELECT *, no AS account, CASE WHEN op = 'transfer' THEN 'debit' ELSE op END AS action, 0 AS leg FROM ops
             UNION ALL SELECT *, to_no, 'credit', 1 FROM ops WHERE op = 'transfer'),
    l AS MATERIALIZED (
      SELECT *, {_OPENING_ERRORS} AS bad, coalesce(open_date, op_date) AS od,
             row_number() OVER (PARTITION BY account ORDER BY seq, leg) AS rn FROM legs),
    start AS (SELECT DISTINCT account, CAST(0 AS BIGINT) AS rn, false AS alive, false AS closed, CAST(NULL AS DATE) AS since,
                     CAST(NULL AS BIGINT) AS balance, CAST(NULL AS VARCHAR) AS errors FROM l),
    f AS (SELECT * FROM start
          UNION ALL
          SELECT account, rn, alive OR (action = 'open' AND e = ''),
                 closed OR (e = '' AND (action = 'close' OR (action = 'open' AND close_date IS NOT NULL))),
                 CASE WHEN action = 'open' AND e = '' THEN od ELSE since END,
                 CASE WHEN e <> '' OR action = 'close' THEN balance WHEN action = 'open' THEN 0
                      WHEN action = 'debit' THEN balance - amount ELSE balance + amount END, e
          FROM (SELECT l.account, l.rn, alive, closed, since, balance, action, close_date, od, amount,
                       CASE WHEN action = 'open' AND alive THEN concat('Already existing account with no ', l.account)
                            WHEN action = 'open' THEN bad
                            WHEN NOT alive THEN concat('Account ', l.account, ' does not exist')
                            ELSE concat_ws('; ',
                              CASE WHEN closed THEN concat('Account ', l.account, ' is already closed') END,
                              CASE WHEN action = 'close' AND coalesce(close_date, op_date) < since
                                   THEN concat('Close date [', coalesce(close_date, op_date), '] cannot be earlier than open date [', since, ']') END,
                              CASE WHEN action = 'debit' AND balance < amount
                                   THEN concat('Insufficient amount in ', l.account, ' to debit') END) END AS e
                FROM f JOIN l ON l.account = f.account AND l.rn = f.rn + 1)),
    r AS (SELECT l.*, f.errors, f.errors = '' AS ok, f.balance FROM l JOIN f ON l.account = f.account AND l.rn = f.rn)
"""


def _results(spark, sf):
    return ledger.run(_ops(spark, sf))


@query(
    "v06_check_openings",
    f"""
    WITH ops AS ({_DUCK_OPS}), o AS (SELECT *, {_OPENING_ERRORS} AS bad FROM ops WHERE op = 'open')
    SELECT seq, no, CASE WHEN taken > 0 THEN concat('Already existing account with no ', no) ELSE bad END AS errors
    FROM (SELECT *, count(*) FILTER (bad = '') OVER (PARTITION BY no ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS taken
          FROM o)
    """,
)
def _(spark, sf):
    df = ledger.check_openings(_ops(spark, sf).where("op = 'open'"))
    return df.select("seq", "no", joined("errors", "; ").alias("errors"))


@query("v07_closings", f"{_LEDGER} SELECT seq, account, ok, errors FROM r WHERE action = 'close'")
def _(spark, sf):
    df = _results(spark, sf).where("action = 'close'")
    return df.select("seq", "account", "ok", joined("errors", "; ").alias("errors"))


@query("v08_ledger", f"{_LEDGER} SELECT seq, account, leg, action, ok, errors, balance FROM r")
def _(spark, sf):
    df = _results(spark, sf)
    return df.select("seq", "account", "leg", "action", "ok", joined("errors", "; ").alias("errors"), "balance")


@query(
    "v08_half_done_transfers",
    f"""
    {_LEDGER} SELECT seq, bool_or(ok AND leg = 0) AS debited, bool_or(ok AND leg = 1) AS credited
    FROM r WHERE op = 'transfer' GROUP BY 1 HAVING bool_or(ok AND leg = 0) <> bool_or(ok AND leg = 1)
    """,
)
def _(spark, sf):
    return ledger.half_done_transfers(_results(spark, sf))


@query(
    "v09_balance_or_error",
    f"""
    {_LEDGER}, b AS (SELECT account, arg_max(balance, rn) AS balance FROM r WHERE balance IS NOT NULL GROUP BY 1)
    SELECT no, balance, CASE WHEN balance IS NULL THEN concat('No account exists with no ', no) END AS error
    FROM (SELECT concat('ACC', c_custkey) AS no FROM customer) LEFT JOIN b ON account = no
    """,
)
def _(spark, sf):
    wanted = table(spark, sf, "customer").select(F.concat(F.lit("ACC"), "c_custkey").alias("no"))
    return ledger.balance_of(wanted, ledger.balances(_results(spark, sf)))


@query(
    "v10_rates",
    f"""
    {_LEDGER} SELECT account AS no, CASE WHEN type = 'savings' THEN CAST(rate AS DOUBLE) END AS rate FROM r WHERE action = 'open' AND ok
    """,
)
def _(spark, sf):
    df = ledger.rates(ledger.accounts(_results(spark, sf)))
    return df.withColumn("rate", F.col("rate").cast("double"))


@query(
    "a16_balances",
    f"{_LEDGER} SELECT account AS no, arg_max(balance, rn) AS balance FROM r WHERE balance IS NOT NULL GROUP BY 1",
)
def _(spark, sf):
    return ledger.balances(_results(spark, sf))


@query(
    "a17_opened_on",
    f"{_LEDGER} SELECT account AS no, type FROM r WHERE action = 'open' AND ok AND od = DATE '1992-02-01'",
)
def _(spark, sf):
    df = ledger.opened_on(ledger.accounts(_results(spark, sf)), "1992-02-01")
    return df.select("no", "type")
