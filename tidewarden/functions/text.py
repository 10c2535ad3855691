"""Text shaping: ids, labels, number text, letter folding."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Polish letters and their ASCII forms, position by position.
POLISH_LETTERS = "ąćęłńóśżźĄĆĘŁŃÓŚŻŹ"
ASCII_LETTERS = "acelnoszzACELNOSZZ"

# Labels and colours of the alert board and the map.
SEVERITY_LABELS = {"Yellow": "Żółty", "Orange": "Pomarańczowy", "Red": "Czerwony"}
SEVERITY_COLORS = {"Yellow": "#D97706", "Orange": "#EA580C", "Red": "#DC2626"}
OTHER_COLOR = "#888"
ALERT_TYPE_LABELS = {"storm": "Burza", "flood": "Powódź"}
MISSING_NUMBER = "—"


def fold_polish(text: Column) -> Column:
    """Polish letters as ASCII; null becomes empty text."""
    return F.translate(F.coalesce(text, F.lit("")), POLISH_LETTERS, ASCII_LETTERS)


def prefixed(prefix: str, identifier: Column) -> Column:
    return F.concat(F.lit(prefix), identifier.cast("string"))


def zero_padded(text: Column, width: int = 2) -> Column:
    """Left-padded with zeros; text already longer than ``width`` stays whole."""
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)


def number_text(number: Column, decimals: int, unit: str = "") -> Column:
    """Fixed-point text with a unit, a dash where there is no number.

    The binary value itself is rounded, halves to the even digit: 2.25 is ``2.2``, and 1.005, which
    lies just below its decimal form, is ``1.00``. The plain format rounds the decimal form, so it
    differs only where that is at a half, or next to it; there the exact value decides.
    """
    value, scale = number.cast("double"), 10.0 ** decimals
    form = f"%.{decimals}f{unit.replace('%', '%%')}"
    scaled = value * scale
    # Wider than what the product and the decimal form are off.
    near = F.abs(scaled - F.floor(scaled) - 0.5) <= 1e-6 + F.abs(scaled) * 1e-15
    # A lambda is not compiled with the query, which keeps its code small, and runs for few numbers.
    exact = F.transform(F.array(value), lambda v: F.format_string(form, _rounded(v, scale)))[0]
    return F.when(near & (F.abs(scaled) < 2.0 ** 52), exact).when(
        number.isNotNull(), F.format_string(form, value)).otherwise(F.lit(MISSING_NUMBER))


def _rounded(value: Column, scale: float) -> Column:
    """The value rounded to a multiple of ``1 / scale``, with its sign if that is 0."""
    scaled = value * scale
    down = F.floor(scaled).cast("double")
    part = scaled - down
    # What the product lost: at an apparent half it tells on which side the number lies.
    lost = _product_error(value, scale, scaled)
    up = (part > 0.5) | ((part == 0.5) & ((lost > 0) | ((lost == 0) & (down % 2 != 0))))
    shown = F.when(up, down + 1).otherwise(down) / scale
    return F.when((value < 0) & (shown == 0), F.lit(-0.0)).otherwise(shown)


def _product_error(a: Column, b: float, product: Column) -> Column:
    """Exact ``a * b`` less the rounded ``product``, from halves of 26 bits each."""
    splitter = 134217729.0
    high = splitter * a - (splitter * a - a)
    low = a - high
    b_high = splitter * b - (splitter * b - b)
    b_low = b - b_high
    return ((high * b_high - product) + high * b_low + low * b_high) + low * b_low


def optional(prefix: str, value: Column) -> Column:
    """``prefix`` and the value, or empty text if the value is missing."""
    return (F.when(value.isNotNull(), F.concat(F.lit(prefix), value.cast("string")))
            .otherwise(F.lit("")))


def looked_up(code: Column, table: Mapping[str, str], fallback: Column) -> Column:
    """Label of a code, ``fallback`` for codes outside the table."""
    pairs = [F.lit(part) for pair in table.items() for part in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), code), fallback)


def station_label(identifier: Column, name: Column) -> Column:
    """``name (id)``, or the bare id without a name of its own."""
    has_name = name.isNotNull() & (name != "") & (name != identifier)
    return (F.when(has_name, F.concat(name, F.lit(" ("), identifier, F.lit(")")))
            .otherwise(identifier))


def logical_key(identifier: Column, time_text: Column) -> Column:
    """One text key of a reading: id, bar, time."""
    return F.concat_ws("|", identifier, time_text)
