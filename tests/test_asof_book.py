"""The book of many end dates against a book of each date."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from riskbook.functions.dates import in_window, window_start
from riskbook.operators import asof_book, book


@pytest.mark.parametrize("first,last", [(a, a + n) for a in (0, 5, 10227, 10240) for n in (0, 1, 2, 6, 31, 90, 181)])
def test_pieces_are_the_days(first, last):
    got = [d for level, block in asof_book.pieces(first, last) for d in range(block << level, (block + 1) << level)]
    assert sorted(got) == list(range(first, last + 1))
    assert len(asof_book.pieces(first, last)) <= 2 * (last - first + 1).bit_length()


def test_book_of_each_date(spark):
    rng = random.Random(2)
    day = lambda: (date(2024, 2, 28) - timedelta(days=rng.randrange(60))).isoformat()
    rows = [
        (rng.choice(["hot", "hot", "a", "b", "c", None]), rng.choice([1, 2, None]), rng.choice(["r1", "r2", None]), rng.choice([1.0, 2.5, 40.0, float("nan"), None, 0.0]), rng.randrange(5), day())
        for _ in range(400)
    ] + [("x", 1, "r1", 3.0, 1, "not a day")]
    fin = spark.createDataFrame(rows, "nr_cpf_cnpj_sender string, cd_bank_sender int, nr_cpf_cnpj_receiver string, vl_titulo double, qtd_titulo int, dat_ref_carga string").repartition(3)
    flagged = spark.createDataFrame([("r1", 1), ("r1", 1), ("r2", 0)], "nr_cpf_cnpj string, fl_cartola int")
    ends = ["2024-02-28", "2024-02-27", "2024-02-01", "2024-01-15", "2023-06-01"]
    got = {}
    for r in asof_book.book_as_of(fin, flagged, ends, 15).collect():
        got.setdefault(r["dat_ref_fim"], []).append(tuple(r)[1:])
    for end in ends:
        alone = book.trailing_book(in_window(fin, window_start(end, days=16), end), flagged, end, 15)
        expected = sorted(map(tuple, alone.collect()), key=str)
        found = sorted(got.get(end, []), key=str)
        assert len(found) == len(expected)
        for a, b in zip(found, expected, strict=True):
            assert a[0] == b[0] and a[1:] == pytest.approx(b[1:])
    assert asof_book.book_as_of(fin.where(F.lit(False)), flagged, ends, 15).count() == 0
