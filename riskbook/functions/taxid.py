"""Tax-id check digits (C8) as Spark column expressions.

A person id is 9 base digits + 2 check digits, a company id 12 + 2. Each
check digit is ``11 - (weighted digit sum mod 11)``, or 0 when that is 10 or
more; the second digit's weights also cover the first check digit.
Everything is one JVM-side SQL expression: no UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The public weight sequences of the two id forms.
PERSON_WEIGHTS_1 = [10, 9, 8, 7, 6, 5, 4, 3, 2]
PERSON_WEIGHTS_2 = [11, 10, 9, 8, 7, 6, 5, 4, 3, 2]
COMPANY_WEIGHTS_1 = [5, 4, 3, 2, 9, 8, 7, 6, 5, 4, 3, 2]
COMPANY_WEIGHTS_2 = [6, 5, 4, 3, 2, 9, 8, 7, 6, 5, 4, 3, 2]

FORMS = {
    # doc type: (total length, first weights, second weights)
    "F": (11, PERSON_WEIGHTS_1, PERSON_WEIGHTS_2),
    "J": (14, COMPANY_WEIGHTS_1, COMPANY_WEIGHTS_2),
}


def _check_digit_sql(id_sql: str, weights: list[int]) -> str:
    # Digit i is ascii(char i) - 48; the format check (all digits) is ANDed
    # in by the caller, so other characters never make an id valid.
    total = " + ".join(f"{w} * (ascii(substr({id_sql}, {i + 1}, 1)) - 48)" for i, w in enumerate(weights))
    return f"(case when 11 - pmod({total}, 11) >= 10 then 0 else 11 - pmod({total}, 11) end)"


def is_valid_tax_id(id_col: str, type_col: str) -> Column:
    """1 when column ``id_col`` holds a well-formed id of the form named in
    column ``type_col`` ('F' person, 'J' company), else 0.

    Malformed input (wrong length, non-digits, unknown or null type) is 0,
    never an error. Plain positional arithmetic in one SQL expression, so it
    runs inside whole-stage codegen (no lambdas, no UDF).
    """
    i, t = f"`{id_col}`", f"`{type_col}`"
    forms = []
    for form, (length, w1, w2) in FORMS.items():
        forms.append(
            f"({t} = '{form}' and {i} rlike '^[0-9]{{{length}}}$'"
            f" and ascii(substr({i}, {length - 1}, 1)) - 48 = {_check_digit_sql(i, w1)}"
            f" and ascii(substr({i}, {length}, 1)) - 48 = {_check_digit_sql(i, w2)})"
        )
    return F.expr(f"case when coalesce({' or '.join(forms)}, false) then 1 else 0 end")
