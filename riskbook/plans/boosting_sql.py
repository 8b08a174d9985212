"""The boosted trees as DuckDB SQL, unrolled for a given number of trees and levels.

Written from the objective and the split rule, not from the Spark steps: bins by dense ranks of buckets,
sums by a join of bins and gradients, the best split by a window, rows moved by an update of their node.
Expects a table ``master`` (id, features, label) among the steps before it.
"""

from __future__ import annotations

from collections.abc import Sequence

from riskbook.functions.buckets import PER_OCTAVE
from riskbook.operators.boosting import MAX_BINS, PRIME, UNIT, Grower, Params


def bucket_sql(v: str, per_octave: int = PER_OCTAVE) -> str:
    """The number of a value's bucket (not for nulls, NaN and infinities)."""
    size = f"abs({v})"
    guess = f"floor(log2({size}))"
    exponent = f"(case when power(2.0, {guess}) > {size} then {guess} - 1 when power(2.0, {guess} + 1) <= {size} then {guess} + 1 else {guess} end)"
    number = f"(({exponent} + 1100) * {per_octave} + floor(({size} / power(2.0, {exponent}) - 1) * {per_octave}) + 1)"
    return f"(case when {v} = 0 then 0 when {v} > 0 then {number} else -{number} end)::bigint"


def boosted_steps(features: Sequence[str], params: Params, id_col: str, label: str) -> list[tuple[str, str]]:
    """Named steps; the last are ``margin_<n_estimators>`` (id, margin) and ``splits`` (feature, gain)."""
    p, trees, unit = params, params.n_estimators, f"{int(UNIT)}::double"
    thresholded = lambda g: f"(greatest(abs({g}) - {p.reg_alpha!r}, 0.0))"
    score = lambda g, h: f"({thresholded(g)} * {thresholded(g)} / ({h} + {p.reg_lambda!r}))"
    leaf = lambda g, h: f"(-(case when {g} < 0 then -1 else 1 end) * {thresholded(g)} / ({h} + {p.reg_lambda!r}) * {p.learning_rate!r})"
    listed = ", ".join(f"cast({f} as double)" for f in features)
    steps = [
        ("long", f"select {id_col} as id, unnest(range({len(features)})) as f, unnest([{listed}]) as v from master"),
        ("bucketed", f"select id, f, {bucket_sql('v')} as bucket from long"),
        ("counted", "select f, bucket, count(*) as n from bucketed group by all"),
        ("placed", f"select f, bucket, floor((sum(n) over (partition by f order by bucket) - n) * {MAX_BINS - 1} / sum(n) over (partition by f)) as place from counted"),
        ("numbered", "select f, bucket, dense_rank() over (partition by f order by place) as bin from placed"),
        ("binned", "select id, f, bin from bucketed join numbered using (f, bucket)"),
        ("people", f"select {id_col} as id, {label} as y, ('0x' || substr(md5({id_col}), 1, 8))::bigint % {PRIME} as k from master"),
        ("margin_0", "select id, 0.0::double as margin from people"),
    ]
    gains = []
    model = Grower(params)
    for t in range(trees):
        model.begin(len(features))
        columns, (a, b) = model.columns, model.draw
        model.trees.append(model.tree)
        share = params.subsample * PRIME
        steps.append((
            f"gradient_{t}",
            f"""select id, floor((p - y) * {unit} + 0.5)::bigint as g, floor(p * (1.0 - p) * {unit} + 0.5)::bigint as h
            from (select q.id, q.y, q.k, 1.0 / (1.0 + exp(-m.margin)) as p from people q join margin_{t} m using (id)) r
            where (k * {a} + {b}) % {PRIME} < {share!r}""",
        ))
        steps.append((f"at_{t}_0", "select id, 0::bigint as node from people"))
        steps.append((f"values_{t}_0", f"select 0::bigint as node, {leaf('g', 'h')} as value from (select sum(g)::double / {unit} as g, sum(h)::double / {unit} as h from gradient_{t}) s"))
        for level in range(params.max_depth):
            here = f"{t}_{level}"
            first = 2**level - 1
            steps.append((
                f"sums_{here}",
                f"""select node, f, bin, sum(g)::bigint as g, sum(h)::bigint as h
                from gradient_{t} join at_{here} using (id) join binned using (id)
                where node >= {first} and f in ({", ".join(map(str, columns))}) group by all""",
            ))
            steps.append((
                f"sides_{here}",
                f"""select node, f, bin, (sum(g) over upto)::double / {unit} as gl, (sum(h) over upto)::double / {unit} as hl,
                (sum(g) over whole)::double / {unit} as g, (sum(h) over whole)::double / {unit} as h
                from sums_{here} window upto as (partition by node, f order by bin), whole as (partition by node, f)""",
            ))
            steps.append((
                f"best_{here}",
                f"""select * from (select *, row_number() over (partition by node order by gain desc, f, bin) as rn
                from (select *, {score("gl", "hl")} + {score("(g - gl)", "(h - hl)")} - {score("g", "h")} as gain from sides_{here}
                      where hl >= {params.min_child_weight!r} and h - hl >= {params.min_child_weight!r}) c) r where rn = 1 and gain > {params.gamma!r}""",
            ))
            gains.append(f"select f, gain from best_{here}")
            steps.append((
                f"at_{t}_{level + 1}",
                f"""select a.id, case when s.node is null then a.node when x.bin <= s.bin then 2 * a.node + 1 else 2 * a.node + 2 end as node
                from at_{here} a left join best_{here} s using (node) left join binned x on x.id = a.id and x.f = s.f""",
            ))
            steps.append((
                f"values_{t}_{level + 1}",
                f"""select * from values_{here} union all select 2 * node + 1, {leaf("gl", "hl")} from best_{here}
                union all select 2 * node + 2, {leaf("(g - gl)", "(h - hl)")} from best_{here}""",
            ))
        end = f"{t}_{params.max_depth}"
        steps.append((f"margin_{t + 1}", f"select m.id, m.margin + v.value as margin from margin_{t} m join at_{end} using (id) join values_{end} v using (node)"))
    steps.append(("splits", " union all ".join(gains)))
    return steps


def with_steps(head: str, steps: Sequence[tuple[str, str]], body: str) -> str:
    """``head`` (a WITH list) followed by the steps, each computed once, and the body."""
    return head + "".join(f",\n{name} as materialized ({sql})" for name, sql in steps) + f"\n{body}"
