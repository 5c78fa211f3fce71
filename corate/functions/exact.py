"""Sums of doubles that do not depend on the order of the rows.

A double is cut into integer limbs of 30 bits on a fixed binary grid. Limbs
are summed as bigint, which is exact and merges in any order; carries are
brought in once, at the end, and the digits are then turned into one double.
Everything is built-in integer arithmetic, so sums stay inside map-side
aggregates.
"""

from __future__ import annotations

from math import frexp

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LIMB = 30
_MASK = (1 << LIMB) - 1


def _shift(c: Column) -> Column:
    return F.shiftright(c, LIMB)


def _low(c: Column) -> Column:
    return c.bitwiseAND(F.lit(_MASK).cast("bigint"))


def limbs(x: Column, top: int, n: int) -> list[Column]:
    """The n limbs of ``x``, least first, each with the sign of ``x``; ``x`` is
    below 2^top in size and what lies below 2^(top - 30 n) is cut off."""
    rest, out = F.abs(x) * F.lit(2.0 ** (LIMB - top)), []
    for _ in range(n):
        limb = F.floor(rest)
        rest = (rest - limb.cast("double")) * F.lit(2.0**LIMB)  # exact, as rest is not negative
        out.append(F.when(x < 0, -limb).otherwise(limb))
    return out[::-1]


def _let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once, however often it is used."""
    return F.get(F.transform(F.array(value), body), 0)


def carried(digits: Column) -> Column:
    """An array of limb sums, least first, with the carries brought in: digits below 2^30 and a signed top."""
    none = F.struct(F.lit(0).cast("bigint").alias("c"), F.array().cast("array<bigint>").alias("d"))
    step = lambda acc, x: _let(acc["c"] + x, lambda v: F.struct(_shift(v).alias("c"), F.concat(acc["d"], F.array(_low(v))).alias("d")))
    return F.aggregate(digits, none, step, lambda acc: F.concat(acc["d"], F.array(acc["c"])))


def as_double(digits: Column, scale: int) -> Column:
    """The number of an array of limb sums, times 2^scale.

    Worked out from its absolute value, so that the leading bits are right
    however much has cancelled. One expression of fixed size: chains of
    columns would grow with every step the optimizer substitutes.
    """
    size = lambda d: F.aggregate(F.reverse(d), F.lit(0.0), lambda acc, x: acc * F.lit(2.0**LIMB) + x.cast("double")) * F.lit(2.0**scale)
    return _let(carried(digits), lambda d: F.when(F.element_at(d, -1) < 0, -size(carried(F.transform(d, lambda x: -x)))).otherwise(size(d)))


class ExactSum:
    """Sum of a column over a group: ``aggregates()`` for ``agg``, ``finish`` on its result.

    Values are below 2^top in size; the grid reaches down to 2^(top - 30 n).
    Groups hold up to 2^33 rows. Null values are left out, NaN counts as 0; a
    sum of nothing is null.
    """

    def __init__(self, value: Column, name: str, top: int = 40, n: int = 5):
        self.value, self.name, self.top, self.n = value, name, top, n

    def aggregates(self) -> list[Column]:
        return [F.sum(c).alias(f"_{self.name}s{i}") for i, c in enumerate(limbs(self.value, self.top, self.n))]

    def cut(self, df: DataFrame) -> tuple[DataFrame, list[Column]]:
        """(``df`` with the limbs as columns, their aggregates): the limbs are cut
        one after the other, so that none writes out those before it again."""
        v, rest = f"_{self.name}v", f"_{self.name}r"
        df = df.withColumn(v, self.value.cast("double")).withColumn(rest, F.abs(v) * F.lit(2.0 ** (LIMB - self.top)))
        names = [f"_{self.name}l{i}" for i in range(self.n)]
        for name in reversed(names):
            df = df.withColumn(name, F.floor(rest))
            df = df.withColumn(rest, (F.col(rest) - F.col(name).cast("double")) * F.lit(2.0**LIMB))
        signed = lambda c: F.when(F.col(v) < 0, -F.col(c)).otherwise(F.col(c))
        return df, [F.sum(signed(c)).alias(f"_{self.name}s{i}") for i, c in enumerate(names)]

    def finish(self, df: DataFrame) -> DataFrame:
        cols = [f"_{self.name}s{i}" for i in range(self.n)]
        return df.withColumn(self.name, as_double(F.array(*cols), self.top - LIMB * self.n)).drop(*cols)


class ExactMoments:
    """Pearson correlation of pairs (x, y) from exact sums.

    ``top``: |x| and |y| are below 2^top. Values are cut to a grid of
    2^(top - 60); doubles within a factor of 2^7 of the bound are on it, so
    that nothing is cut. x and y have two limbs, their products four; up to
    2^30 pairs a group.
    """

    def __init__(self, x: Column, y: Column, top: int):
        self.x, self.y, self.top = limbs(x, top, 2), limbs(y, top, 2), top

    @classmethod
    def of(cls, df: DataFrame, x: str, y: str, top: int) -> tuple[DataFrame, ExactMoments]:
        """(``df`` with the limbs of x and y in their place, the moments of these limbs).

        The sums then read columns: with the cuts written out in each of the
        16 sums, the generated methods get too long for the JVM to compile."""
        m = cls(F.col(x), F.col(y), top)
        rest = [c for c in df.columns if c not in (x, y)]
        names = {f"_l{k}{i}": c for k, cs in (("x", m.x), ("y", m.y)) for i, c in enumerate(cs)}
        m.x, m.y = ([F.col(f"_l{k}{i}") for i in range(2)] for k in "xy")
        return df.select(*rest, *[c.alias(k) for k, c in names.items()]), m

    @staticmethod
    def _product(a: list[Column], b: list[Column]) -> list[Column]:
        low, mid, high = a[0] * b[0], a[0] * b[1] + a[1] * b[0], a[1] * b[1]
        return [_low(low), _shift(low) + _low(mid), _shift(mid) + _low(high), _shift(high)]

    def aggregates(self) -> list[Column]:
        sums = {"x": self.x, "y": self.y, "xy": self._product(self.x, self.y), "xx": self._product(self.x, self.x), "yy": self._product(self.y, self.y)}
        return [F.sum(c).alias(f"_{k}{i}") for k, cs in sums.items() for i, c in enumerate(cs)]

    @staticmethod
    def finish(df: DataFrame, n: str, name: str = "sim") -> DataFrame:
        """``df`` with the correlation ``name``: 0 for a constant series or no
        covariance, exactly. A single pair is constant: it is left out first."""
        width = {"x": 2, "y": 2, "xy": 4, "xx": 4, "yy": 4}
        digits = {k: carried(F.array(*[f"_{k}{i}" for i in range(w)])) for k, w in width.items()}

        def centred(both: str, a: str, b: str) -> Column:
            """n * sum(ab) - sum(a) * sum(b), digit by digit."""
            def limb(p: Column, x: Column, y: Column, d: int) -> Column:
                out = F.col(n) * p[d]
                for i in range(3):
                    if 0 <= d - i < 3:
                        out = out - x[i] * y[d - i]
                return out
            return _let(digits[both], lambda p: _let(digits[a], lambda x: _let(digits[b], lambda y: as_double(F.array(*[limb(p, x, y, d) for d in range(5)]), 0))))

        def correlation(m: Column) -> Column:
            num, vx, vy = m[0], m[1], m[2]
            return F.when((num != 0) & (vx > 0) & (vy > 0), num / (F.sqrt(vx) * F.sqrt(vy))).otherwise(F.lit(0.0))

        sim = _let(F.array(centred("xy", "x", "y"), centred("xx", "x", "x"), centred("yy", "y", "y")), correlation)
        sim = F.when(F.col(n) > 1, sim).otherwise(F.lit(0.0))
        return df.withColumn(name, sim).drop(*[f"_{k}{i}" for k, w in width.items() for i in range(w)])


def top_bit(largest: float | None) -> int:
    """Least ``top`` with every |x| up to ``largest`` below 2^top."""
    return frexp(abs(largest or 0.0))[1]
