"""Column helpers that add meaning to Spark's built-in functions.

All of them build JVM-side Column expressions (no Python UDFs), so they stay
inside whole-stage code generation.
"""

from tessera.functions.hashing import draw_below, hash_unit
from tessera.functions.money import (avg_money, cents, half_up_div, int_div,
                                     money_from_cents, round_ratio, sum_money)

__all__ = ["avg_money", "cents", "half_up_div", "int_div", "money_from_cents",
           "round_ratio", "sum_money", "draw_below", "hash_unit"]
