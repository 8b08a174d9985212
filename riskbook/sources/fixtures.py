"""Test inputs in the reference's schemas, derived from the driver's tables.

Each fixture is one SQL text over the base tables (``lineitem``, ``orders``,
``customer``, ``supplier``, ``part``, ``events``) that runs unchanged in Spark SQL and
DuckDB. Spark reads the Parquet files directly (``parquet.`path```), so the
scan still prunes and pushes filters; the DuckDB oracle gets the same text
as leading CTEs. Amounts are integer-valued doubles, so sums are exact in any
order on either engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskbook.functions.taxid import (
    COMPANY_WEIGHTS_1,
    COMPANY_WEIGHTS_2,
    PERSON_WEIGHTS_1,
    PERSON_WEIGHTS_2,
)
from riskbook.session import spread
from riskbook.sources.versions import _fs

# Parameters of every fixture query.
END_DATE = "1998-06-30"
DAYS_TO_EVALUATE = 180
RANK_LO, RANK_HI = 3, 8
DEEP_LO, DEEP_HI = 875, 1300  # a band below the first thousand places
SEED = 42
SAMPLE_FRACTION = 0.005
CUTOFF = 0.5
RETRAIN_THRESHOLD = 0.85
FOLDS = 3

CHANNELS = ("PIX", "TED", "DOC")

_TRANSFER_COLUMNS = (
    "nr_cpf_cnpj_sender, nr_account_sender, nr_office_sender, cd_bank_sender, "
    "nr_cpf_cnpj_receiver, nr_account_receiver, nr_office_receiver, cd_bank_receiver, "
    "vl_pgto, dat_ref_carga"
)

_TRANSFER_SOURCE = """
select cast(o_custkey as varchar(20)) as nr_cpf_cnpj_sender,
  lpad(cast(100000 + o_custkey as varchar(20)), 8, '0') as nr_account_sender,
  cast(1000 + o_custkey % 25 as varchar(20)) as nr_office_sender,
  cast(o_custkey % 5 + 1 as varchar(20)) as cd_bank_sender,
  case when l_partkey % 211 = 0 then null else cast(1000000 + l_partkey as varchar(20)) end as nr_cpf_cnpj_receiver,
  lpad(cast(200000 + l_partkey as varchar(20)), 8, '0') as nr_account_receiver,
  cast(2000 + l_partkey % 25 as varchar(20)) as nr_office_receiver,
  cast(l_partkey % 5 + 1 as varchar(20)) as cd_bank_receiver,
  (l_quantity - 5) * 10 as vl_pgto,
  substr(cast(o_orderdate as varchar(30)), 1, 10) as dat_ref_carga,
  case l_returnflag when 'R' then 'PIX' when 'A' then 'TED' else 'DOC' end as tp_transacao
from {lineitem} join {orders} on l_orderkey = o_orderkey
"""

# Receivers grow with the data (one per part); a few are null. Every l_linenumber = 1 row appears twice: exact replays for the duplicate rule.
_TRANSFERS_RAW = f"""
select {_TRANSFER_COLUMNS}, tp_transacao from ({_TRANSFER_SOURCE.strip()}) t
union all
select {_TRANSFER_COLUMNS}, tp_transacao from ({_TRANSFER_SOURCE.strip()} where l_linenumber = 1) r
"""

# The same feeds as text files would bring them: senders missing, numbers and amounts that are none.
_TRANSFERS_MALFORMED = f"""
select case when cast(nr_account_sender as integer) % 17 = 0 then null else nr_cpf_cnpj_sender end as nr_cpf_cnpj_sender,
  case when cast(nr_account_sender as integer) % 7 = 0 then 'x' || nr_account_sender else nr_account_sender end as nr_account_sender,
  case when cast(nr_account_receiver as integer) % 11 = 0 then '' else nr_office_sender end as nr_office_sender,
  case when cast(nr_account_receiver as integer) % 9 = 0 then 'n/a' else cd_bank_sender end as cd_bank_sender,
  nr_cpf_cnpj_receiver, nr_account_receiver, nr_office_receiver,
  case when cast(nr_account_sender as integer) % 13 = 0 then null else cd_bank_receiver end as cd_bank_receiver,
  case when cast(vl_pgto as integer) % 170 = 0 then 'n/a' when cast(vl_pgto as integer) % 130 = 0 then ''
       when cast(vl_pgto as integer) % 110 = 0 then cast(cast(vl_pgto as integer) as varchar(20)) || ',00'
       when cast(vl_pgto as integer) % 70 = 0 then null
       else cast(vl_pgto as varchar(30)) end as vl_pgto,
  dat_ref_carga, tp_transacao
from ({_TRANSFERS_RAW.strip()}) m
"""

# One account per customer; companies have one or two, however large the data.
_PERSONS = """
select cast(c_custkey as varchar(20)) as nr_cpf_cnpj, 'F' as cd_tipo_doc,
  cast(c_custkey % 5 + 1 as varchar(20)) as cd_bank, cast(1000 + c_custkey % 25 as varchar(20)) as nr_office,
  lpad(cast(100000 + c_custkey as varchar(20)), 8, '0') as nr_account from {customer}
union all
select cast(1000000 + p_partkey as varchar(20)), 'J', cast(p_partkey % 5 + 1 as varchar(20)),
  cast(2000 + p_partkey % 25 as varchar(20)), lpad(cast(200000 + p_partkey as varchar(20)), 8, '0') from {part}
union all
select cast(1000000 + p_partkey as varchar(20)), 'J', '7',
  '2999', lpad(cast(700000 + p_partkey as varchar(20)), 8, '0') from {part} where p_partkey % 3 = 0
"""

# One zero row per customer (as the reference fabricates) plus events moved back 9345 days.
_CAMPANHAS = """
select cast(c_custkey as varchar(20)) as nr_cpf_cnpj, 0 as camp_disparo, 0 as camp_conversao,
  '1998-06-30' as dat_ref_carga from {customer}
union all
select cast(user_id as varchar(20)), 1, case when event_type = 'purchase' then 1 else 0 end,
  substr(cast(cast(ts as date) - interval '9345' day as varchar(30)), 1, 10) from {events}
"""

_RISCOS = """
select cast(o_custkey as varchar(20)) as nr_cpf_cnpj, substr(cast(o_orderdate as varchar(30)), 1, 10) as dat_ref_carga,
  1 as flag_bloqueio
from {orders} where o_orderstatus = 'F' and o_orderpriority = '1-URGENT'
"""

# Duplicates and fl_cartola = 0 rows on purpose.
_FLAGGED = """
select cast(1000000 + p_partkey as varchar(20)) as nr_cpf_cnpj,
  case when p_partkey % 50 < 8 then 1 else 0 end as fl_cartola from {part}
union all
select cast(1000000 + p_partkey as varchar(20)), 1 from {part} where p_partkey % 100 = 1
"""

# Margins far outside [0, 1], positive and negative.
_MARGINS = """
select cast(o_orderkey as varchar(20)) as nr_cpf_cnpj, substr(cast(o_orderdate as varchar(30)), 1, 7) as mes,
  cast(o_totalprice as double) - cast(150000 as double) as score,
  case when o_orderkey % 11 = 0 then 2 when o_orderstatus = 'F' then 1 else 0 end as label
from {orders}
"""

# Scores with ties on purpose; single days may hold one class only.
_SCORES = """
select cast(o_orderkey as varchar(20)) as nr_cpf_cnpj,
  substr(cast(o_orderdate as varchar(30)), 1, 10) as dat_ref_carga,
  cast(o_orderkey % 97 as double) / cast(97 as double) as score,
  case when o_orderstatus = 'F' then 1 else 0 end as label
from {orders}
"""


def _check_digits_sql(base: str, weights: list[int], prev: str | None = None) -> str:
    """SQL text for one check digit of ``base`` (plus ``prev`` as the last digit).
    Both Spark and DuckDB read it.
    """
    terms = [f"{w} * cast(substr({base}, {i + 1}, 1) as integer)" for i, w in enumerate(weights[: len(weights) - (1 if prev else 0)])]
    if prev:
        terms.append(f"{weights[-1]} * {prev}")
    total = " + ".join(terms)
    return f"(case when 11 - ({total}) % 11 >= 10 then 0 else 11 - ({total}) % 11 end)"


def _tax_ids_sql() -> str:
    p1 = _check_digits_sql("b", PERSON_WEIGHTS_1)
    p2 = _check_digits_sql("b", PERSON_WEIGHTS_2, prev="dv1")
    c1 = _check_digits_sql("b", COMPANY_WEIGHTS_1)
    c2 = _check_digits_sql("b", COMPANY_WEIGHTS_2, prev="dv1")
    # Valid ids, a corrupted last digit on every 10th (persons) / 7th
    # (companies) key, and a truncated id on keys ending in 7 (persons).
    return f"""
select case when k % 10 = 0 then b || cast(dv1 as varchar(2)) || cast((dv2 + 1) % 10 as varchar(2))
            when k % 10 = 7 then substr(b || cast(dv1 as varchar(2)) || cast(dv2 as varchar(2)), 1, 10)
            else b || cast(dv1 as varchar(2)) || cast(dv2 as varchar(2)) end as nr_cpf_cnpj,
       'F' as cd_tipo_doc
from (select k, b, dv1, {p2} as dv2
      from (select k, b, {p1} as dv1
            from (select c_custkey as k, lpad(cast(c_custkey * 7919 as varchar(30)), 9, '0') as b
                  from {{customer}}) s1) s2) s3
union all
select case when k % 7 = 0 then b || cast(dv1 as varchar(2)) || cast((dv2 + 3) % 10 as varchar(2))
            else b || cast(dv1 as varchar(2)) || cast(dv2 as varchar(2)) end,
       'J'
from (select k, b, dv1, {c2} as dv2
      from (select k, b, {c1} as dv1
            from (select s_suppkey as k, lpad(cast(s_suppkey * 104729 as varchar(30)), 12, '0') as b
                  from {{supplier}}) c1) c2) c3
"""


BASE_SQL = {
    "transfers_raw": _TRANSFERS_RAW,
    "transfers_malformed": _TRANSFERS_MALFORMED,
    "persons": _PERSONS,
    "raw_campanhas": _CAMPANHAS,
    "raw_riscos": _RISCOS,
    "flagged_table": _FLAGGED,
    "score_history": _SCORES,
    "score_margins": _MARGINS,
    "tax_ids": _tax_ids_sql(),
}

_BASE_TABLES = ("lineitem", "orders", "customer", "supplier", "part", "events")


def _spark_sql(name: str, sf_dir: str) -> str:
    refs = {t: f"parquet.`{sf_dir.rstrip('/')}/{t}.parquet`" for t in _BASE_TABLES}
    return BASE_SQL[name].format(**refs)


# Folders whose fixture tables were written as Parquet (see write_inputs).
_WRITTEN: dict[str, str] = {}


def write_inputs(spark: SparkSession, sf_dir: str, folder: str) -> None:
    """Write every fixture table of ``sf_dir`` as Parquet below ``folder``; from then on
    :func:`fixture` reads those, so plans start from plain tables as in production."""
    for name in BASE_SQL:
        fixture(spark, sf_dir, name).write.mode("overwrite").parquet(f"{folder}/{name}")
    _WRITTEN[sf_dir.rstrip("/")] = folder


def _input_bytes(spark: SparkSession, sf_dir: str) -> int:
    """Length of the base tables' files."""
    out = 0
    for t in _BASE_TABLES:
        fs, at = _fs(spark, f"{sf_dir.rstrip('/')}/{t}.parquet")
        out += fs.getContentSummary(at).getLength() if fs.exists(at) else 0
    return out


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One fixture table over ``sf_dir``; channel names give one raw feed."""
    spread(spark, _input_bytes(spark, sf_dir))
    if sf_dir.rstrip("/") in _WRITTEN and name in BASE_SQL:
        return spark.read.parquet(f"{_WRITTEN[sf_dir.rstrip('/')]}/{name}")
    if name in CHANNELS or name.lower() in {f"raw_{c.lower()}" for c in CHANNELS}:
        from riskbook.operators.transfers import split_channels

        channel = name.upper().replace("RAW_", "")
        return split_channels(fixture(spark, sf_dir, "transfers_raw"), "tp_transacao", [channel])[channel]
    if name == "transfers":
        return fixture(spark, sf_dir, "transfers_raw").drop("tp_transacao")
    return spark.sql(_spark_sql(name, sf_dir))


def raw_channels(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The three raw feeds (``raw_pix``, ``raw_ted``, ``raw_doc``)."""
    from riskbook.operators.transfers import split_channels

    return split_channels(fixture(spark, sf_dir, "transfers_raw"), "tp_transacao", list(CHANNELS))


# ---------------------------------------------------------------- DuckDB side

_DERIVED_SQL = {
    "raw_pix": f"select {_TRANSFER_COLUMNS} from transfers_raw where tp_transacao = 'PIX'",
    "raw_ted": f"select {_TRANSFER_COLUMNS} from transfers_raw where tp_transacao = 'TED'",
    "raw_doc": f"select {_TRANSFER_COLUMNS} from transfers_raw where tp_transacao = 'DOC'",
    "transfers": f"select {_TRANSFER_COLUMNS} from transfers_raw",
}
_DERIVED_DEPS = {k: ["transfers_raw"] for k in _DERIVED_SQL}


def fixture_sql(name: str) -> str:
    """DuckDB SQL of a fixture table over the views of the base tables."""
    return BASE_SQL[name].format(**{t: t for t in _BASE_TABLES}).strip()


def oracle_ctes(names: list[str], body: str, extra: list[tuple[str, str]] = ()) -> str:
    """``WITH`` the named fixtures (DuckDB views of base tables), then the
    ``extra`` (name, sql) steps, then ``body``."""
    ordered: list[str] = []
    for n in names:
        for dep in _DERIVED_DEPS.get(n, []):
            if dep not in ordered:
                ordered.append(dep)
        if n not in ordered:
            ordered.append(n)
    parts = []
    for n in ordered:
        text = _DERIVED_SQL[n] if n in _DERIVED_SQL else fixture_sql(n)
        parts.append(f"{n} as ({text.strip()})")
    for n, text in extra:
        parts.append(f"{n} as ({text.strip()})")
    return "with " + ",\n".join(parts) + "\n" + body.strip()
