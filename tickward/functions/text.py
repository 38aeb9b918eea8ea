"""Text expressions: stripping, number formats and notification wording."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values -----------------------------------------------------------------------------
# Characters a field is stripped of (Unicode white space).
WHITESPACE = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
MONEY_FORMAT = "0.00"
PROFIT_HEADLINE = "📈 {asset} hit your profit target!"
LOSS_HEADLINE = "📉 {asset} dropped below your stop-loss!"
PRICE_LINE = "Current price: ${price}"
PROFIT_LINE = "(target: ${level} = {purchase} * (1 + {percent}/100))"
LOSS_LINE = "(limit: ${level} = {purchase} * (1 - {percent}/100))"
INVALID_FORMAT = (
    "❌ Invalid format. Please use:\n"
    "crypto_type=..., purchase_price=..., profit=..., loss=..."
)
# ------------------------------------------------------------------------------------------


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITESPACE))


def money(c: Column) -> Column:
    """Two decimals, rounded on the exact binary value (``format_string`` rounds the decimal text)."""
    return F.call_function("format_number", c, F.lit(MONEY_FORMAT))


def plain(c: Column) -> Column:
    """Shortest decimal text that reads back as the same number, never with an exponent.

    ``cast`` gives the shortest digits but writes ``1.0E7`` from ten million on and ``1.0E-4`` below a
    thousandth; the point is moved by as many places as the exponent says.
    """
    return plain_texts(c)[0]


def plain_texts(*values: Column) -> Column:
    """``plain`` of each value, as an array.

    The long expression that moves a point stands here once, inside a function over the array, and runs only for rows with an exponent, instead of being
    written out for each value and wording.
    """
    texts = F.array(*[v.cast("string") for v in values])
    return F.when(F.exists(texts, lambda t: t.contains("E")), F.transform(texts, _without_exponent)).otherwise(texts)


def _without_exponent(text: Column) -> Column:
    sign = F.when(text.startswith("-"), F.lit("-")).otherwise(F.lit(""))
    body = F.ltrim(text, F.lit("-"))
    mantissa, power = F.substring_index(body, "E", 1), F.substring_index(body, "E", -1).try_cast("int")
    whole, tail = F.substring_index(mantissa, ".", 1), F.regexp_replace(F.substring_index(mantissa, ".", -1), "^0$", "")
    digits, places = F.concat(whole, tail), F.length(tail)
    small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -power - 1), digits)
    large = F.concat(F.rpad(digits, power + 1, F.lit("0")), F.lit(".0"))
    between = F.concat(F.left(digits, power + 1), F.lit("."), F.substring(digits, power + 2, places))
    moved = F.when(power < 0, small).when(places <= power, large).otherwise(between)
    return F.when(body.contains("E"), F.concat(sign, moved)).otherwise(text)


def fill(template: str, **parts: Column) -> Column:
    """Concatenate a ``{name}`` template with columns."""
    pieces: list[Column] = []
    rest = template
    while rest:
        before, brace, after = rest.partition("{")
        if before:
            pieces.append(F.lit(before))
        if not brace:
            break
        name, _, rest = after.partition("}")
        pieces.append(parts[name])
    return F.concat(*pieces)


def alert_text(side: Column, asset: Column, price: Column, target: Column, limit: Column, operands: Column) -> Column:
    """Three-line notification text for a fired rule; ``operands`` are the plain texts of purchase, profit and loss."""
    gain, loss = side == "profit", side == "loss"
    profit_parts = fill(PROFIT_LINE, level=money(target), purchase=operands[0], percent=operands[1])
    loss_parts = fill(LOSS_LINE, level=money(limit), purchase=operands[0], percent=operands[2])
    lines = F.concat_ws(
        "\n",
        F.when(gain, fill(PROFIT_HEADLINE, asset=asset)).when(loss, fill(LOSS_HEADLINE, asset=asset)),
        fill(PRICE_LINE, price=money(price)),
        F.when(gain, profit_parts).when(loss, loss_parts),
    )
    return F.when(gain | loss, lines)
