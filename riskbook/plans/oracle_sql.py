"""DuckDB oracle SQL, one statement per catalogue key.

Written from the reference's semantics, not from our Spark plans: the book
is seven aggregated subqueries left-joined to the sender list, behavioural
features are a literal FULL OUTER join, the flag is an IN subquery, ranks
are window functions. Date bounds are computed by DuckDB's own date
arithmetic. Every computed column is cast to the Spark type it must match.
"""

from __future__ import annotations

import re

from riskbook.operators.auc_state import PER_OCTAVE
from riskbook.plans.boosting_sql import boosted_steps, bucket_sql, with_steps
from riskbook.sources.fixtures import DAYS_TO_EVALUATE as DAYS
from riskbook.sources.fixtures import (
    CUTOFF,
    DEEP_HI,
    DEEP_LO,
    END_DATE,
    FOLDS,
    RANK_HI,
    RANK_LO,
    RETRAIN_THRESHOLD,
    SAMPLE_FRACTION,
    SEED,
    fixture_sql,
    oracle_ctes,
)

# The book windows at DAYS = 180.
BOOK_WINDOWS = [1, 7, 15, 30, 60, 90, 180]


FEED = "tp_transacao"


def _start(days: int) -> str:
    return f"strftime(date '{END_DATE}' - interval '{days}' day, '%Y-%m-%d')"


def _between(days: int) -> str:
    return f"dat_ref_carga between {_start(days)} and '{END_DATE}'"


def _clean(feed: str, extra: str = "", days: int = DAYS) -> str:
    return f"""
select distinct {extra}cast(nr_cpf_cnpj_sender as varchar) as nr_cpf_cnpj_sender,
  try_cast(nr_account_sender as integer) as nr_account_sender,
  try_cast(nr_office_sender as integer) as nr_office_sender,
  try_cast(cd_bank_sender as integer) as cd_bank_sender,
  cast(nr_cpf_cnpj_receiver as varchar) as nr_cpf_cnpj_receiver,
  try_cast(nr_account_receiver as integer) as nr_account_receiver,
  try_cast(nr_office_receiver as integer) as nr_office_receiver,
  try_cast(cd_bank_receiver as integer) as cd_bank_receiver,
  cast(vl_pgto as double) as vl_titulo,
  cast(dat_ref_carga as varchar) as dat_ref_carga
from {feed}
where {_between(days + 1)} and cast(vl_pgto as double) > 0
"""


_KEYS9 = (
    "nr_cpf_cnpj_sender, nr_account_sender, nr_office_sender, cd_bank_sender, "
    "nr_cpf_cnpj_receiver, nr_account_receiver, nr_office_receiver, cd_bank_receiver, dat_ref_carga"
)


def _pairs(clean_sql: str, extra: str = "") -> str:
    return f"""
select {extra}{_KEYS9}, sum(vl_titulo) as vl_titulo, cast(count(*) as integer) as qtd_titulo
from ({clean_sql}) c group by {extra}{_KEYS9}
"""


def _financial(days: int = DAYS) -> str:
    return " union all ".join(f"({_pairs(_clean(feed, days=days))})" for feed in ("raw_pix", "raw_ted", "raw_doc"))


FINANCIAL = _financial()
FEEDS = ["raw_pix", "raw_ted", "raw_doc"]

CAMPAIGN_DAILY = f"""
select nr_cpf_cnpj, dat_ref_carga,
  cast(sum(camp_disparo) as bigint) as qtd_camp_disparo,
  cast(sum(camp_conversao) as bigint) as qtd_camp_conversao
from (select cast(nr_cpf_cnpj as varchar) as nr_cpf_cnpj, try_cast(camp_disparo as integer) as camp_disparo,
             try_cast(camp_conversao as integer) as camp_conversao, cast(dat_ref_carga as varchar) as dat_ref_carga
      from raw_campanhas where {_between(DAYS + 1)}) c
group by nr_cpf_cnpj, dat_ref_carga
"""

RISK_WINDOW = f"""
select cast(nr_cpf_cnpj as varchar) as nr_cpf_cnpj, try_cast(flag_bloqueio as integer) as flag_bloqueio,
  cast(dat_ref_carga as varchar) as dat_ref_carga
from raw_riscos where {_between(DAYS + 1)}
"""

BEHAVIORAL = f"""
select nr_cpf_cnpj, cast(sum(d) as bigint) as qtd_camp_disparo, cast(sum(c) as bigint) as qtd_camp_conversao,
  cast(max(f) as integer) as flag_bloqueio
from (select coalesce(c.nr_cpf_cnpj, r.nr_cpf_cnpj) as nr_cpf_cnpj,
             coalesce(c.qtd_camp_disparo, 0) as d, coalesce(c.qtd_camp_conversao, 0) as c,
             coalesce(r.flag_bloqueio, 0) as f
      from ({CAMPAIGN_DAILY}) c full outer join ({RISK_WINDOW}) r
        on c.nr_cpf_cnpj = r.nr_cpf_cnpj and c.dat_ref_carga = r.dat_ref_carga) j
group by nr_cpf_cnpj
"""

FLAGGED_IN = "(select nr_cpf_cnpj from flagged_table where fl_cartola = 1)"

_MEASURES = [
    ("vl_tran_total_sum", "sum(vl_tran)"),
    ("qt_tran_total_sum", "sum(qt_tran)"),
    ("vl_tran_sant_bets_sum", "sum(case when sant = 1 and bet = 1 then vl_tran else 0 end)"),
    ("qt_tran_sant_bets_sum", "sum(case when sant = 1 and bet = 1 then qt_tran else 0 end)"),
    ("vl_tran_sant_bets_max", "max(case when sant = 1 and bet = 1 then vl_tran else 0 end)"),
    ("qt_tran_sant_bets_max", "max(case when sant = 1 and bet = 1 then qt_tran else 0 end)"),
    ("vl_tran_sant_bets_min", "min(case when sant = 1 and bet = 1 then vl_tran else 0 end)"),
    ("qt_tran_sant_bets_min", "min(case when sant = 1 and bet = 1 then qt_tran else 0 end)"),
]


def _book_sql(days: int = DAYS) -> str:
    fin = f"""
select nr_cpf_cnpj_sender as nr_cpf_cnpj, vl_titulo as vl_tran, qtd_titulo as qt_tran, dat_ref_carga,
  case when cd_bank_sender = 1 then 1 else 0 end as sant,
  case when nr_cpf_cnpj_receiver in {FLAGGED_IN} then 1 else 0 end as bet
from financial"""
    joins = []
    cols = []
    for d in (w for w in BOOK_WINDOWS if w <= days):
        aggs = ", ".join(f"{expr} as {name}_{d}" for name, expr in _MEASURES)
        joins.append(
            f"left join (select nr_cpf_cnpj, {aggs} from fin where {_between(d)} group by nr_cpf_cnpj) w{d} "
            f"on b.nr_cpf_cnpj = w{d}.nr_cpf_cnpj"
        )
        for name, _ in _MEASURES:
            t = "double" if name.startswith("vl") else "integer"
            cols.append(f"cast(coalesce(w{d}.{name}_{d}, 0) as {t}) as {name}_{d}")
    return (
        f"fin as ({fin}), book_ids as (select distinct nr_cpf_cnpj_sender as nr_cpf_cnpj from financial), "
        f"book as (select b.nr_cpf_cnpj, {', '.join(cols)} from book_ids b {' '.join(joins)})"
    )


def _with(names: list[str], body: str, steps: list[tuple[str, str]] = ()) -> str:
    return oracle_ctes(names, body, list(steps))


def _financial_steps(days: int = DAYS) -> list[tuple[str, str]]:
    return [("financial", _financial(days))]


def _book_with(body: str, days: int = DAYS) -> str:
    # The book needs the financial table and the flagged list.
    text = oracle_ctes(FEEDS + ["flagged_table"], "select 1", _financial_steps(days))
    head = text[: text.rfind("select 1")].rstrip()
    return f"{head},\n{_book_sql(days)}\n{body}"


def _window_bounds() -> str:
    from riskbook.plans.catalog import BOUND_OFFSETS

    cols = []
    for name, (d, m, y) in BOUND_OFFSETS.items():
        expr = f"cast(dat_ref_carga as date) - interval '{d}' day"
        if m + 12 * y:
            expr = f"({expr}) - interval '{m + 12 * y}' month"
        cols.append(f"strftime({expr}, '%Y-%m-%d') as {name}")
    return _with(["transfers"], f"select distinct dat_ref_carga, {', '.join(cols)} from transfers")


RECEIVED = """
select t.*, p.cd_tipo_doc
from transfers t join (select nr_cpf_cnpj, cd_tipo_doc from persons) p on t.nr_cpf_cnpj_receiver = p.nr_cpf_cnpj
where p.cd_tipo_doc = 'J'
"""
TOTALS = "select nr_cpf_cnpj_receiver, sum(vl_pgto) as vl_total_recebido from received group by nr_cpf_cnpj_receiver"


def _band(lo: int, hi: int) -> str:
    return f"""
select nr_cpf_cnpj_receiver as nr_cpf_cnpj, 1 as fl_cartola
from (select nr_cpf_cnpj_receiver,
             row_number() over (order by vl_total_recebido desc, nr_cpf_cnpj_receiver) as rn
      from totals) r
where rn >= {lo} and rn < {hi}
"""


BAND = _band(RANK_LO, RANK_HI)
LAST = """
select t.nr_cpf_cnpj_sender as nr_cpf_cnpj, max(t.dat_ref_carga) as data_ulti_trans_cartola
from transfers t join band b on t.nr_cpf_cnpj_receiver = b.nr_cpf_cnpj
group by t.nr_cpf_cnpj_sender
"""
SAMPLE_STEPS = [
    ("f_ids", "select distinct nr_cpf_cnpj from persons where cd_tipo_doc = 'F'"),
    ("n_pick", f"select greatest(1, cast(floor(count(*) * {SAMPLE_FRACTION}) as bigint)) as n from f_ids"),
    (
        "ranked",
        f"select nr_cpf_cnpj, row_number() over (order by md5(nr_cpf_cnpj || ':{SEED}'), nr_cpf_cnpj) as rn from f_ids",
    ),
    (
        "days",
        "select dat_ref_carga, row_number() over (order by dat_ref_carga) as di "
        "from (select distinct dat_ref_carga from transfers where dat_ref_carga is not null) d",
    ),
    ("n_days", "select count(*) as nd from days"),
    (
        "sample",
        f"""select r.nr_cpf_cnpj, d.dat_ref_carga as data_ulti_trans_cartola_1
        from ranked r cross join n_pick cross join n_days
        join days d on d.di = (('0x' || substr(md5(r.nr_cpf_cnpj || ':{SEED}:date'), 1, 8))::bigint % n_days.nd) + 1
        where r.rn <= n_pick.n""",
    ),
]
LABEL_STEPS = [
    ("received", RECEIVED),
    ("totals", TOTALS),
    ("band", BAND),
    ("last", LAST),
    *SAMPLE_STEPS,
    (
        "labels",
        """select i.nr_cpf_cnpj, coalesce(l.data_ulti_trans_cartola, s.data_ulti_trans_cartola_1) as dat_ref_carga,
        1 as flag_bloqueio
        from f_ids i left join last l on i.nr_cpf_cnpj = l.nr_cpf_cnpj left join sample s on i.nr_cpf_cnpj = s.nr_cpf_cnpj""",
    ),
]


def _tax_valid_sql() -> str:
    # Weights written as position formulas: persons 10..2 / 11..2; companies
    # 5..2,9..2 / 6..2,9..2.
    def digit(i):
        return f"try_cast(substr(nr_cpf_cnpj, cast({i} as integer), 1) as integer)"

    def dv(n, weight):
        s = f"list_sum(list_transform(range(1, {n + 1}), lambda i: {digit('i')} * ({weight})))"
        return f"(case when 11 - {s} % 11 >= 10 then 0 else 11 - {s} % 11 end)"

    person = (
        "(cd_tipo_doc = 'F' and regexp_full_match(nr_cpf_cnpj, '[0-9]{11}') "
        f"and {digit(10)} = {dv(9, '11 - i')} and {digit(11)} = {dv(10, '12 - i')})"
    )
    company = (
        "(cd_tipo_doc = 'J' and regexp_full_match(nr_cpf_cnpj, '[0-9]{14}') "
        f"and {digit(13)} = {dv(12, 'case when i <= 4 then 6 - i else 14 - i end')} "
        f"and {digit(14)} = {dv(13, 'case when i <= 5 then 7 - i else 15 - i end')})"
    )
    return f"""
select cd_tipo_doc, fl_valido, count(*) as qtd
from (select cd_tipo_doc,
             case when coalesce(case when cd_tipo_doc = 'F' then {person}
                                     when cd_tipo_doc = 'J' then {company} end, false)
                  then 1 else 0 end as fl_valido
      from tax_ids) v
group by cd_tipo_doc, fl_valido
"""


def _auc_sql(group_expr: str, group_name: str, table: str = "score_history") -> str:
    # Rank-sum form of the Mann-Whitney statistic, average ranks for ties; rows that cannot be ranked are counted.
    return f"""
select {group_name}, cast(coalesce(sum(label) filter (ok), 0) as bigint) as n_pos,
  cast(coalesce(sum(1 - label) filter (ok), 0) as bigint) as n_neg,
  cast(count(*) filter (not ok) as bigint) as n_unusable,
  case when sum(label) filter (ok) > 0 and sum(1 - label) filter (ok) > 0 then
    (sum(case when label = 1 then avg_rank else 0 end) filter (ok)
       - cast(sum(label) filter (ok) as double) * (sum(label) filter (ok) + 1) / 2.0)
    / (cast(sum(label) filter (ok) as double) * cast(sum(1 - label) filter (ok) as double)) end as roc_auc
from (select {group_name}, label, ok,
             cast(rank() over (partition by {group_name}, ok order by score) as double)
             + (count(*) over (partition by {group_name}, ok, score) - 1) / 2.0 as avg_rank
      from (select {group_expr} as {group_name}, score, label,
                   coalesce(score is not null and label in (0, 1), false) as ok from {table}) s) r
group by {group_name}
"""


def build() -> dict[str, str]:
    from riskbook.plans.catalog import SQL_PARAMS

    q: dict[str, str] = {}
    q["window_bounds"] = _window_bounds()
    clean = _clean("transfers_raw", f"{FEED}, ")
    q["clean_transfers"] = _with(["transfers_raw"], clean)
    q["clean_transfers_timestamps"] = q["clean_transfers"]
    q["daily_pairs"] = _with(["transfers_raw"], _pairs(clean, f"{FEED}, "))
    q["financial_features"] = _with(FEEDS, FINANCIAL)
    q["financial_features_feeds"] = q["financial_features"]
    q["campaign_daily"] = _with(["raw_campanhas"], CAMPAIGN_DAILY)
    q["risk_window"] = _with(["raw_riscos"], RISK_WINDOW)
    q["behavioral_features"] = _with(["raw_campanhas", "raw_riscos"], BEHAVIORAL)
    q["mark_flagged"] = _with(
        FEEDS + ["flagged_table"],
        f"select f.*, case when nr_cpf_cnpj_receiver in {FLAGGED_IN} then 1 else 0 end as bet_trans from financial f",
        _financial_steps(),
    )
    q["own_bank_flag"] = _with(
        FEEDS,
        "select f.*, case when cd_bank_sender = 1 then 1 else 0 end as sant_trans from financial f",
        _financial_steps(),
    )
    q["trailing_book"] = _book_with("select * from book")
    q["trailing_book_30"] = _book_with("select * from book", 30)
    # The same statements over the malformed feeds, whose amounts are text.
    for key in ("clean_transfers", "trailing_book"):
        other = q[key].replace(fixture_sql("transfers_raw"), fixture_sql("transfers_malformed"))
        q[f"{key}_malformed"] = other.replace(" cast(vl_pgto as double)", " try_cast(vl_pgto as double)").replace("\n  cast(vl_pgto as double)", "\n  try_cast(vl_pgto as double)")
    from riskbook.plans.catalog import AS_OF

    # A book of each date on its own, with that date in place of the fixture's.
    q["book_as_of"] = " union all ".join(f"select '{d}' as dat_ref_fim, * from ({q['trailing_book'].replace(END_DATE, d)}) b" for d in AS_OF)
    q["labelled_master"] = _labelled_sql("select * from master")
    features = [f"{name}_{d}" for d in BOOK_WINDOWS for name, _ in _MEASURES] + ["qtd_camp_disparo", "qtd_camp_conversao"]
    rows = " union all ".join(f"select nr_cpf_cnpj, '{f}' as feature, cast({f} as double) as value from master" for f in features)
    q["assembled_features"] = _labelled_sql(rows)
    last = f"margin_{SQL_PARAMS.n_estimators}"
    chance = "1.0 / (1.0 + exp(-margin))"
    q["score_contract"] = _boosted(features, f"select id as nr_cpf_cnpj, round({chance}, 9) as probabilidade_inadimplente, cast({chance} >= {CUTOFF} as integer) as flag_predito from {last}")
    q["model_reload"] = q["contribution_sums"] = _boosted(features, f"select id as nr_cpf_cnpj, round(margin, 9) as margin from {last}")
    names = ", ".join(f"'{f}'" for f in features)
    q["importance_names"] = _boosted(
        features,
        f"""select n.feature, count(s.gain) as n_splits, round(coalesce(sum(s.gain), 0), 6) as total_gain,
          round(coalesce(sum(s.gain) / (select sum(gain) from splits), 0), 6) as importance
        from (select unnest([{names}]) as feature, unnest(range({len(features)})) as f) n left join splits s using (f) group by n.feature""",
    )
    scored = ("scored", f"select 'x' as day, margin as score, flag_bloqueio as label from {last} join master on id = nr_cpf_cnpj")
    q["gate_reuse"] = _boosted(
        features,
        f"select '{END_DATE}' as dat_ref_carga, 0 as retrained, 1 as same_model, round(roc_auc, 9) as roc_auc from ({_auc_sql('day', 'day', 'scored')}) a",
        [scored],
    )
    q["master_table"] = _master_sql("select * from master")
    q["class_balance"] = _master_sql('select flag_bloqueio, count(*) as "count" from master group by flag_bloqueio')
    q["split_channels"] = _with(["transfers_raw"], "select * from transfers_raw")
    q["write_channels"] = q["split_channels"]
    q["received_by_type"] = _with(["transfers", "persons"], RECEIVED)
    q["receiver_totals"] = _with(["transfers", "persons"], TOTALS, [("received", RECEIVED)])
    q["rank_band"] = _with(["transfers", "persons"], "select * from band", LABEL_STEPS[:3])
    q["rank_band_deep"] = _with(
        ["transfers", "persons"], "select * from deep", [*LABEL_STEPS[:2], ("deep", _band(DEEP_LO, DEEP_HI))]
    )
    q["last_flagged_transfer"] = _with(["transfers", "persons"], "select * from last", LABEL_STEPS[:4])
    q["sample_customers"] = _with(["transfers", "persons"], "select * from sample", SAMPLE_STEPS)
    q["derive_labels"] = _with(
        ["transfers", "persons"], "select * from labels where dat_ref_carga is not null", LABEL_STEPS
    )
    q["check_tax_ids"] = _with(["tax_ids"], _tax_valid_sql())
    q["assign_fold"] = _master_sql(
        f"select nr_cpf_cnpj, cast(('0x' || substr(md5(nr_cpf_cnpj || ':{SEED}'), 1, 8))::bigint % {FOLDS} as integer)"
        " as fold from master"
    )
    q["roc_auc"] = _with(["score_history"], _auc_sql("substr(dat_ref_carga, 1, 7)", "mes"))
    q["roc_auc_margins"] = _with(["score_margins"], _auc_sql("mes", "mes", "score_margins"))
    daily = _auc_sql("dat_ref_carga", "dat_ref_carga")
    q["auc_by_date"] = _with(["score_history"], daily)
    q["needs_retrain"] = _with(
        ["score_history"],
        f"""select d.dat_ref_carga, d.roc_auc, p.roc_auc as roc_auc_anterior,
          case when p.roc_auc is null or p.roc_auc < {RETRAIN_THRESHOLD} then 1 else 0 end as fl_retreinar
        from daily d left join daily p
          on p.dat_ref_carga = strftime(cast(d.dat_ref_carga as date) - interval '1' day, '%Y-%m-%d')""",
        [("daily", daily)],
    )
    q["threshold_label"] = _with(
        ["score_history"], f"select *, cast(score >= {CUTOFF} as integer) as flag_predito from score_history"
    )
    q["table_replaced"] = q["read_or_create"] = q["incremental_features"] = q["table_roundtrip"] = q["table_roundtrip_partitioned"] = q["financial_features"]
    q["full_outer_hot"] = """
select left_key, o_orderstatus, right_key, c_nationkey
from (select case when o_orderkey % 7 = 0 then null when o_orderkey % 3 = 0 then 1 else o_custkey + 1 end as left_key, o_orderstatus from orders) l
full outer join (select case when c_custkey % 11 = 0 then null else c_custkey end as right_key, c_nationkey from customer) r on left_key = right_key"""
    q["auc_sketch"] = _with(
        ["score_history"],
        f"""
select mes, cast(sum(p) as bigint) as n_pos, cast(sum(n) as bigint) as n_neg,
  round(sum(p * (b + n * 0.5)) / nullif(cast(sum(p) as double) * sum(n), 0), 9) as roc_auc, round(sum(cast(p as double) * n) * 0.5 / nullif(cast(sum(p) as double) * sum(n), 0), 9) as error
from (select *, cast(coalesce(sum(n) over (partition by mes order by bucket rows between unbounded preceding and 1 preceding), 0) as double) as b
      from (select substr(dat_ref_carga, 1, 7) as mes, {bucket_sql("score", PER_OCTAVE)} as bucket,
                   cast(count(*) filter (label = 1) as double) as p, cast(count(*) filter (label = 0) as double) as n
            from score_history where score is not null and label in (0, 1) group by all) c) d
group by mes""",
    )
    return q


def _boosted(features: list[str], body: str, more: list[tuple[str, str]] = ()) -> str:
    """The trees of the catalogue's small model, grown in SQL on the labelled master."""
    from riskbook.plans.catalog import SQL_PARAMS

    # Every step once: left to choose, DuckDB plans the whole chain anew for each of its many uses.
    head = re.sub(r"(?m)(^with |, ?\n?|\n)(\w+) as \(", r"\1\2 as materialized (", _labelled_sql("").rstrip())
    return with_steps(head, [*boosted_steps(features, SQL_PARAMS, "nr_cpf_cnpj", "flag_bloqueio"), *more], body)


def _labelled_sql(body: str) -> str:
    """The master over the derived flagged list and risk table instead of the given ones."""
    steps = [
        *LABEL_STEPS,
        ("flagged_table", "select * from band"),
        ("raw_riscos", "select * from labels where dat_ref_carga is not null"),
        *_financial_steps(),
        ("behavioral", BEHAVIORAL),
    ]
    text = oracle_ctes(["transfers", "persons", *FEEDS, "raw_campanhas"], "select 1", steps)
    head = text[: text.rfind("select 1")].rstrip()
    return (
        f"{head},\n{_book_sql()},\n"
        "master as (select b.*, h.qtd_camp_disparo, h.qtd_camp_conversao, h.flag_bloqueio "
        "from book b join behavioral h on b.nr_cpf_cnpj = h.nr_cpf_cnpj)\n"
        f"{body}"
    )


def _master_sql(body: str) -> str:
    text = oracle_ctes(
        FEEDS + ["flagged_table", "raw_campanhas", "raw_riscos"],
        "select 1",
        _financial_steps() + [("behavioral", BEHAVIORAL)],
    )
    head = text[: text.rfind("select 1")].rstrip()
    return (
        f"{head},\n{_book_sql()},\n"
        "master as (select b.*, h.qtd_camp_disparo, h.qtd_camp_conversao, h.flag_bloqueio "
        "from book b join behavioral h on b.nr_cpf_cnpj = h.nr_cpf_cnpj)\n"
        f"{body}"
    )
