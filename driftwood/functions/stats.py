"""Statistical Column functions: normal CDF, Gaussian density, Hoeffding bound.

Spark has no ``erf``; the normal CDF is a rational Chebyshev fit of
``erfc`` written as pure Column arithmetic (fractional error below 1.2e-7),
so it stays inside whole-stage codegen.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Chebyshev coefficients of the erfc fit
# erfc(z) ~ t * exp(-z^2 + P(t)), t = 1 / (1 + z/2), z >= 0, with P(t) =
ERFC_COEFFS = (-1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806,
               0.27886807, -1.13520398, 1.48851587, -0.82215223, 0.17087277)

NORMAL_CONSTANT = math.sqrt(2.0 * math.pi)


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def erfc(x) -> Column:
    x = _c(x).cast("double")
    z = F.abs(x)
    t = F.lit(1.0) / (F.lit(1.0) + F.lit(0.5) * z)
    poly = F.lit(ERFC_COEFFS[-1])
    for c in reversed(ERFC_COEFFS[:-1]):
        poly = F.lit(c) + t * poly
    ans = t * F.exp(-z * z + poly)
    return F.when(x >= 0, ans).otherwise(F.lit(2.0) - ans)


def normal_cdf(z) -> Column:
    """Standard normal CDF Phi(z) = erfc(-z / sqrt 2) / 2."""
    return F.lit(0.5) * erfc(-_c(z).cast("double") / F.lit(math.sqrt(2.0)))


def gaussian_variance(n, m2) -> Column:
    """Variance ``M2/(n-1)``, 0 when ``n <= 1``."""
    n, m2 = _c(n), _c(m2)
    return F.when(n <= 1.0, F.lit(0.0)).otherwise(m2 / (n - F.lit(1.0)))


def gaussian_density(value, n, mean, m2) -> Column:
    """Pdf of the estimator; sd = 0 gives 1 at the mean else 0; n = 0 gives 0."""
    value, n, mean = _c(value), _c(n), _c(mean)
    sd = F.sqrt(gaussian_variance(n, m2))
    pdf = F.exp(-F.pow((value - mean) / sd, 2.0) / 2.0) / (F.lit(NORMAL_CONSTANT) * sd)
    return (F.when((n.isNull()) | (n == 0), F.lit(0.0))
            .when(sd > 0, pdf)
            .when(value == mean, F.lit(1.0))
            .otherwise(F.lit(0.0)))


def finite(x) -> Column:
    """Neither null, NaN nor infinite."""
    x = _c(x).cast("double")
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))


def hoeffding_bound(range_merit, delta: float, n) -> Column:
    """sqrt(R^2 ln(1/delta) / (2 n))."""
    r = _c(range_merit)
    return F.sqrt(r * r * F.lit(math.log(1.0 / delta)) / (F.lit(2.0) * _c(n)))


def log2(x) -> Column:
    return F.log(2.0, _c(x))


def uniform_from_text(*cols, seed: int = 0) -> Column:
    """A uniform in (0, 1): 52 bits of the MD5 of the columns' texts and the seed.

    It depends on the values alone, so a lost task draws the same again.
    """
    texts = [F.coalesce(_c(c).cast("string"), F.lit("")) for c in cols]
    digest = F.md5(F.concat_ws(":", *texts, F.lit(str(seed))).cast("binary"))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(2 ** 52))


def lgamma(z, shift: int = 8) -> Column:
    """ln Gamma(z) for z > 0: Stirling series after shifting z up by ``shift``."""
    z = _c(z).cast("double")
    w = z + F.lit(float(shift))
    stirling = ((w - 0.5) * F.log(w) - w + F.lit(0.5 * math.log(2 * math.pi))
                + F.lit(1.0) / (F.lit(12.0) * w) - F.lit(1.0) / (F.lit(360.0) * F.pow(w, 3.0))
                + F.lit(1.0) / (F.lit(1260.0) * F.pow(w, 5.0)))
    prod = F.lit(0.0)
    for i in range(shift):
        prod = prod + F.log(z + F.lit(float(i)))
    return stirling - prod


def _betacf(a: Column, b: Column, x: Column, iters: int) -> Column:
    """Continued fraction of the incomplete beta (modified Lentz), fixed length."""
    tiny = F.lit(1e-300)

    def clamp(v):
        return F.when(F.abs(v) < tiny, tiny).otherwise(v)

    qab, qap, qam = a + b, a + 1.0, a - 1.0
    d0 = F.lit(1.0) / clamp(F.lit(1.0) - qab * x / qap)
    init = F.struct(d0.alias("d"), F.lit(1.0).alias("c"), d0.alias("h"))

    def step(st, m):
        m = m.cast("double")
        m2 = m * 2.0
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d1 = F.lit(1.0) / clamp(F.lit(1.0) + aa * st["d"])
        c1 = clamp(F.lit(1.0) + aa / st["c"])
        h1 = st["h"] * d1 * c1
        aa2 = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d2 = F.lit(1.0) / clamp(F.lit(1.0) + aa2 * d1)
        c2 = clamp(F.lit(1.0) + aa2 / c1)
        return F.struct(d2.alias("d"), c2.alias("c"), (h1 * d2 * c2).alias("h"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(iters)), init, step)["h"]


def incomplete_beta(x, a, b, iters: int = 300) -> Column:
    """Regularized incomplete beta I_x(a, b) (Column; a, b > 0, 0 <= x <= 1)."""
    x, a, b = _c(x).cast("double"), _c(a).cast("double"), _c(b).cast("double")
    lbeta = lgamma(a + b) - lgamma(a) - lgamma(b)
    front = F.exp(lbeta + a * F.log(x) + b * F.log(F.lit(1.0) - x))
    direct = front * _betacf(a, b, x, iters) / a
    mirror = F.lit(1.0) - front * _betacf(b, a, F.lit(1.0) - x, iters) / b
    return (F.when(x <= 0, F.lit(0.0)).when(x >= 1, F.lit(1.0))
            .when(x < (a + 1.0) / (a + b + 2.0), direct).otherwise(mirror))


#: Degrees of freedom beyond which the tails use asymptotic forms.
LARGE_DOF = 2000


def f_test_pvalue(f, df1, df2) -> Column:
    """Upper tail P(F > f) of the F distribution, for degrees of freedom of any size.

    Two numerator degrees have a closed form.  Small ones use the incomplete beta's
    continued fraction; large ones the shrinking-factor chi-square
    approximation (Li and Martin 2002), whose error falls with the square of the larger degree.
    """
    f, df1, df2 = _c(f).cast("double"), _c(df1).cast("double"), _c(df2).cast("double")
    x = df2 / (df2 + df1 * f)

    def shrunk(g, m, n):  # P(F_{m,n} > g) for n >= m
        factor = (2.0 * n + m * g / 3.0 + m - 2.0) / (2.0 * n + 4.0 * m * g / 3.0)
        return chi2_pvalue(factor * m * g, m)

    large = F.when(df2 >= df1, shrunk(f, df1, df2)).otherwise(F.lit(1.0) - shrunk(F.lit(1.0) / f, df2, df1))
    return (F.when(f <= 0, F.lit(1.0))
            .when(df1 == 2, F.exp(-df2 / 2.0 * F.log1p(2.0 * f / df2)))
            .when(F.greatest(df1, df2) > LARGE_DOF, large)
            .otherwise(incomplete_beta(x, df2 / 2.0, df1 / 2.0)))


def _chi2_small(h: Column, k: Column) -> Column:
    """Closed forms of Q(k/2, h); the terms are summed from their logarithms, so none overflows."""
    lh = F.log(h)

    def total(first: Column, n: Column, step: float) -> Column:
        # terms exp(t_i), t_{i+1} = t_i + ln h - ln(i + step)
        return F.when(n >= 1, F.aggregate(
            F.sequence(F.lit(1), F.greatest(n, F.lit(1))), F.struct(F.lit(0.0).alias("s"), first.alias("t")),
            lambda st, i: F.struct((st["s"] + F.exp(st["t"])).alias("s"),
                                   (st["t"] + lh - F.log(i.cast("double") + F.lit(step))).alias("t")))["s"]).otherwise(F.lit(0.0))

    even = total(-h, (k / 2).cast("int"), 0.0)
    odd = erfc(F.sqrt(h)) + total(lh / 2.0 - F.lit(math.lgamma(1.5)) - h, ((k - 1) / 2).cast("int"), 0.5)
    return F.when(k % 2 == 0, even).otherwise(odd)


def _chi2_large(h: Column, a: Column) -> Column:
    """Q(a, h) for large a by Temme's uniform expansion, two terms."""
    mu = (h - a) / a
    near = F.abs(mu) < 1e-2
    # mu - ln(1 + mu); the series where the difference cancels
    phi = F.when(near, mu * mu * (0.5 - mu / 3.0 + mu * mu / 4.0 - mu * mu * mu / 5.0)).otherwise(mu - F.log1p(mu))
    eta = F.signum(mu) * F.sqrt(2.0 * phi)
    c0 = F.when(near, F.lit(-1.0 / 3.0) + eta / 12.0 - eta * eta * (2.0 / 135.0)).otherwise(
        F.lit(1.0) / F.when(near, F.lit(1.0)).otherwise(mu) - F.lit(1.0) / F.when(near, F.lit(1.0)).otherwise(eta))
    c1 = F.lit(-1.0 / 540.0) - eta / 288.0
    rest = F.exp(-a * phi) / F.sqrt(F.lit(2.0 * math.pi) * a) * (c0 + c1 / a)
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), 0.5 * erfc(eta * F.sqrt(a / 2.0)) + rest))


def chi2_pvalue(x, dof) -> Column:
    """Upper tail of chi-square with integer ``dof`` of any size."""
    x, k = _c(x).cast("double"), _c(dof).cast("bigint")
    h, large = x / 2.0, k > LARGE_DOF
    small = _chi2_small(h, F.when(large, F.lit(1).cast("bigint")).otherwise(k))
    return (F.when(x <= 0, F.lit(1.0)).when(k <= 0, F.lit(float("nan")))
            .when(large, _chi2_large(h, k.cast("double") / 2.0)).otherwise(small))
