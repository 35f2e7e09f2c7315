"""Vectors and rates, as built-in expressions over arrays of doubles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    """Inner product."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    """Length."""
    return F.sqrt(dot(a, a))


def scaled(a: Column, k: Column | float) -> Column:
    """A multiple."""
    return F.transform(a, lambda x: x.cast("double") * k)


def plus(a: Column, b: Column) -> Column:
    """Sum."""
    return F.zip_with(a, b, lambda x, y: x.cast("double") + y.cast("double"))


def cross(a: Column, b: Column) -> Column:
    """Cross product of vectors of three."""
    g = lambda v, k: F.get(v, F.lit(k)).cast("double")
    return F.array(*[g(a, i) * g(b, j) - g(a, j) * g(b, i) for i, j in ((1, 2), (2, 0), (0, 1))])


def rotated(a: Column, angle: Column, axis: Column) -> Column:
    """A vector of three turned about an axis (Rodrigues' formula)."""
    u = scaled(axis, 1 / norm(axis))
    turned = plus(scaled(a, F.cos(angle)), scaled(cross(u, a), F.sin(angle)))
    return plus(turned, scaled(u, dot(u, a) * (1 - F.cos(angle))))


def interpolated(a: Column, b: Column, alpha: Column | float) -> Column:
    """(1 - alpha) a + alpha b, component by component."""
    return F.zip_with(a, b, lambda x, y: (1 - F.lit(alpha)) * x.cast("double") + F.lit(alpha) * y.cast("double"))


def on_line(p: Column, a: Column, b: Column, tolerance: float = 1e-6) -> Column:
    """Whether a point of two lies on the segment from a to b."""
    g = lambda v, k: F.get(v, F.lit(k)).cast("double")
    area = (g(b, 0) - g(a, 0)) * (g(p, 1) - g(a, 1)) - (g(b, 1) - g(a, 1)) * (g(p, 0) - g(a, 0))
    within = [g(p, k).between(F.least(g(a, k), g(b, k)) - tolerance, F.greatest(g(a, k), g(b, k)) + tolerance) for k in (0, 1)]
    return (F.abs(area) <= tolerance) & within[0] & within[1]


def intersection(a: Column, b: Column, c: Column, d: Column) -> Column:
    """Where the lines through a, b and through c, d meet; null where they are parallel."""
    g = lambda v, k: F.get(v, F.lit(k)).cast("double")
    down = (g(a, 0) - g(b, 0)) * (g(c, 1) - g(d, 1)) - (g(a, 1) - g(b, 1)) * (g(c, 0) - g(d, 0))
    first, second = g(a, 0) * g(b, 1) - g(a, 1) * g(b, 0), g(c, 0) * g(d, 1) - g(c, 1) * g(d, 0)
    at = lambda k: (first * (g(c, k) - g(d, k)) - (g(a, k) - g(b, k)) * second) / down
    return F.when(F.abs(down) > 1e-10, F.array(at(0), at(1)))


def smooth(t: Column) -> Column:
    """A rate that begins and ends slowly: a cubic of zero slope at 0 and 1."""
    return 3 * t * t - 2 * t * t * t


def rush_into(t: Column) -> Column:
    """The first half of smooth, twice as far."""
    return 2 * smooth(t / 2)


def rush_from(t: Column) -> Column:
    """The second half of smooth, twice as far."""
    return 2 * smooth(t / 2 + 0.5) - 1


def slow_into(t: Column) -> Column:
    """A quarter circle."""
    return F.sqrt(1 - (1 - t) * (1 - t))


def double_smooth(t: Column) -> Column:
    """Smooth twice over."""
    return F.when(t < 0.5, 0.5 * smooth(2 * t)).otherwise(0.5 * (1 + smooth(2 * t - 1)))


def there_and_back_with_pause(t: Column, pause: float = 1 / 3) -> Column:
    """There, a pause, and back."""
    a = 1 / (1 - pause)
    return F.when(t < 0.5 - pause / 2, smooth(2 * a * t)).when(t < 0.5 + pause / 2, 1.0).otherwise(smooth(2 * a * (1 - t)))


def inverse_interpolated(start: Column, end: Column, value: Column) -> Column:
    """How far value lies from start to end; a half where they are the same."""
    return F.when(start == end, 0.5).otherwise((value - start) / (end - start))


def choose(n: Column, k: Column) -> Column:
    """Binomial coefficient of whole numbers, by products that stay whole; 0 outside of 0 <= k <= n."""
    few = F.least(k, n - k)
    steps = F.when(few > 0, F.sequence(F.lit(1).cast("long"), F.greatest(few, F.lit(1)).cast("long"))).otherwise(F.array().cast("array<bigint>"))
    made = F.aggregate(steps, F.lit(1).cast("decimal(38,0)"), lambda a, i: F.floor(a * (n - i + 1).cast("decimal(19,0)") / i.cast("decimal(19,0)")).cast("decimal(38,0)"))
    return F.when((k < 0) | (k > n), F.lit(0).cast("decimal(38,0)")).otherwise(made)


def sigmoid(x: Column) -> Column:
    """1 / (1 + exp(-x)), without overflow for large x on either side."""
    e = F.exp(-F.abs(x))
    return F.when(x >= 0, 1 / (1 + e)).otherwise(e / (1 + e))


def bisected(f, target: Column, low: Column, high: Column, steps: int = 60) -> Column:
    """Where a rising expression f takes a value, between two bounds: halved as often as doubles can tell apart."""
    ends = F.struct(low.cast("double").alias("lo"), high.cast("double").alias("hi"))

    def halve(a: Column, _: Column) -> Column:
        mid = (a["lo"] + a["hi"]) / 2
        return F.when(f(mid) < target, F.struct(mid.alias("lo"), a["hi"].alias("hi"))).otherwise(F.struct(a["lo"].alias("lo"), mid.alias("hi")))

    found = F.aggregate(F.sequence(F.lit(1), F.lit(steps)), ends, halve)
    return (found["lo"] + found["hi"]) / 2


def inverse_powers(most: Column, cutoff: float = 0.01) -> Column:
    """array<double>: 1, 1/2, 1/3 ... up to 1/most, as far as they reach the cutoff."""
    last = F.least(most, F.lit(int(1 / cutoff + 1e-9)))
    return F.when(last >= 1, F.transform(F.sequence(F.lit(1).cast("long"), F.greatest(last, F.lit(1)).cast("long")), lambda i: 1 / i)).otherwise(F.array().cast("array<double>"))


def hex_color(code: Column) -> Column:
    """array<int> of red, green and blue of #rrggbb; null where it is none."""
    digits = F.regexp_extract(code, "^#?([0-9A-Fa-f]{6})$", 1)
    return F.when(digits != "", F.array(*[F.conv(F.substring(digits, at, 2), 16, 10).cast("int") for at in (1, 3, 5)]))


def chord_regions(points: Column) -> Column:
    """Regions that the chords between so many points on a circle cut it into."""
    return F.greatest(F.lit(1).cast("decimal(38,0)"), 1 + choose(points, F.lit(2)) + choose(points, F.lit(4)))


def path_indices(points: Column, curves: Column) -> Column:
    """array<long>: indices of the points that go into curves of equal numbers of points."""
    used = F.floor(points / curves) * curves
    return F.when(used > 0, F.sequence(F.lit(0).cast("long"), F.greatest(used - 1, F.lit(0)).cast("long"))).otherwise(F.array().cast("array<bigint>"))


def compass(n: Column) -> Column:
    """array<array<double>>: n directions of length 1, evenly around the third axis."""
    at = lambda i: i * 2 * 3.141592653589793 / n
    return F.when(n > 0, F.transform(F.sequence(F.lit(0).cast("long"), F.greatest(n - 1, F.lit(0)).cast("long")), lambda i: F.array(F.cos(at(i)), F.sin(at(i)), F.lit(0.0)))).otherwise(F.array().cast("array<array<double>>"))


def grid(rows: Column, columns: Column, height: Column, width: Column) -> Column:
    """array<array<double>>: points of a grid around the origin, row by row from below; a single row or column lies at the lower end."""
    spread = lambda n, size, i: F.when(n > 1, -size / 2 + i * size / F.greatest(n - 1, F.lit(1))).otherwise(-size / 2)
    count = rows * columns
    point = lambda i: F.array(spread(columns, width, i % columns), spread(rows, height, F.floor(i / columns)), F.lit(0.0))
    return F.when(count > 0, F.transform(F.sequence(F.lit(0).cast("long"), F.greatest(count - 1, F.lit(0)).cast("long")), point)).otherwise(F.array().cast("array<array<double>>"))
