"""The book and the behavioural roll-up worked out row by row in plain Python,
from what they mean: for tiny inputs, to hold the Spark plans against."""

from datetime import date, timedelta


def _num(x):
    return 0 if x is None else x


def book_rows(transfers, flagged, end, windows, own_bank=1):
    """transfers: dicts with sender, bank, receiver, day, amount, count. One dict per sender."""
    last = date.fromisoformat(end)
    book = {}
    for sender in {t["sender"] for t in transfers}:
        row = {"nr_cpf_cnpj": sender}
        for w in windows:
            days = {(last - timedelta(days=k)).isoformat() for k in range(w + 1)}
            mine = [t for t in transfers if sender is not None and t["sender"] == sender and t["day"] in days]
            hit = [t for t in mine if t["bank"] == own_bank and t["receiver"] in flagged]
            for prefix, field in (("vl", "amount"), ("qt", "count")):
                values = [t[field] for t in mine]
                # A transfer that does not match counts as a zero beside those that do.
                marked = [t[field] if t in hit else 0 for t in mine]
                total = sum(values)
                for name, x in (
                    ("total_sum", total),
                    ("sant_bets_sum", sum(marked)),
                    ("sant_bets_max", _largest(marked)),
                    ("sant_bets_min", _smallest(marked)),
                ):
                    row[f"{prefix}_tran_{name}_{w}"] = 0 if x != x else x
        book[sender] = row
    return book


def _largest(values):
    """NaN is larger than any number, as in Spark."""
    return float("nan") if any(v != v for v in values) else max(values, default=0)


def _smallest(values):
    numbers = [v for v in values if v == v]
    return min(numbers) if numbers else (float("nan") if values else 0)


def behavior_rows(campaigns, risks, days):
    """campaigns: (id, sent, converted, day); risks: (id, day, flag). id -> (sent, converted, flag).

    Each day of a customer with campaigns meets each of that day's risk rows; what
    meets nothing stands alone with zeros. A null id never meets anything."""
    sums = {}
    for who, sent, converted, day in campaigns:
        if day in days:
            s = sums.setdefault((who, day), [0, 0])
            s[0] += _num(sent)
            s[1] += _num(converted)
    met = []
    alone = [(who, day, flag) for who, day, flag in risks if day in days]
    for (who, day), (sent, converted) in sums.items():
        flags = [f for w, d, f in alone if who is not None and (w, d) == (who, day)]
        met += [(who, sent, converted, _num(f)) for f in flags] or [(who, sent, converted, 0)]
    met += [(who, 0, 0, _num(f)) for who, day, f in alone if who is None or (who, day) not in sums]
    out = {}
    for who, sent, converted, flag in met:
        a, b, c = out.get(who, (0, 0, None))
        out[who] = (a + sent, b + converted, flag if c is None else max(c, flag))
    return out
