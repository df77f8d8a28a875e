from tillroll.functions.columns import (
    DATE_PARTS,
    as_money,
    return_flag,
    standard_text,
    total_amount,
)

__all__ = ["DATE_PARTS", "as_money", "return_flag", "standard_text", "total_amount"]
