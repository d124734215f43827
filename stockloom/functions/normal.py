"""Standard normal density, distribution, quantile and loss as Column expressions.

Spark has no ``erf``. The rational approximations below are the published ones of Cody
(Math. Comp. 1969, erf/erfc) and Wichura (AS 241, normal quantile); both are accurate to
about 1e-15, and stay inside generated code.
"""

from __future__ import annotations

import math
from functools import reduce
from statistics import NormalDist

from pyspark.sql import Column
from pyspark.sql import functions as F

# Cody's coefficients, by argument range; numerator then denominator, each
# from the lowest power of the polynomial's argument to the highest.
ERF_SMALL = (
    [3.20937758913846947e03, 3.77485237685302021e02, 1.13864154151050156e02,
     3.16112374387056560e00, 1.85777706184603153e-1],
    [2.84423683343917062e03, 1.28261652607737228e03, 2.44024637934444173e02,
     2.36012909523441209e01, 1.0],
)
ERFC_MIDDLE = (
    [1.23033935479799725e03, 2.05107837782607147e03, 1.71204761263407058e03,
     8.81952221241769090e02, 2.98635138197400131e02, 6.61191906371416295e01,
     8.88314979438837594e00, 5.64188496988670089e-1, 2.15311535474403846e-8],
    [1.23033935480374942e03, 3.43936767414372164e03, 4.36261909014324716e03,
     3.29079923573345963e03, 1.62138957456669019e03, 5.37181101862009858e02,
     1.17693950891312499e02, 1.57449261107098347e01, 1.0],
)
ERFC_LARGE = (
    [6.58749161529837803e-4, 1.60837851487422766e-2, 1.25781726111229246e-1,
     3.60344899949804439e-1, 3.05326634961232344e-1, 1.63153871373020978e-2],
    [2.33520497626869185e-3, 6.05183413124413191e-2, 5.27905102951428412e-1,
     1.87295284992346725e00, 2.56852019228982242e00, 1.0],
)
SMALL_LIMIT, MIDDLE_LIMIT = 0.46875, 4.0

# Wichura's coefficients for the centre, the shoulders and the tails.
QUANTILE_CENTRE = (
    [3.3871328727963666080e0, 1.3314166789178437745e2, 1.9715909503065514427e3,
     1.3731693765509461125e4, 4.5921953931549871457e4, 6.7265770927008700853e4,
     3.3430575583588128105e4, 2.5090809287301226727e3],
    [1.0, 4.2313330701600911252e1, 6.8718700749205790830e2, 5.3941960214247511077e3,
     2.1213794301586595867e4, 3.9307895800092710610e4, 2.8729085735721942674e4,
     5.2264952788528545610e3],
)
QUANTILE_SHOULDER = (
    [1.42343711074968357734e0, 4.63033784615654529590e0, 5.76949722146069140550e0,
     3.64784832476320460504e0, 1.27045825245236838258e0, 2.41780725177450611770e-1,
     2.27238449892691845833e-2, 7.74545014278341407640e-4],
    [1.0, 2.05319162663775882187e0, 1.67638483018380384940e0, 6.89767334985100004550e-1,
     1.48103976427480074590e-1, 1.51986665636164571966e-2, 5.47593808499534494600e-4,
     1.05075007164441684324e-9],
)
QUANTILE_TAIL = (
    [6.65790464350110377720e0, 5.46378491116411436990e0, 1.78482653991729133580e0,
     2.96560571828504891230e-1, 2.65321895265761230930e-2, 1.24266094738807843860e-3,
     2.71155556874348757815e-5, 2.01033439929228813265e-7],
    [1.0, 5.99832206555887937690e-1, 1.36929880922735805310e-1, 1.48753612908506148525e-2,
     7.86869131145613259100e-4, 1.84631831751005468180e-5, 1.42151175831644588870e-7,
     2.04426310338993978564e-15],
)


def _ratio(x: Column, coefficients: tuple[list[float], list[float]]) -> Column:
    poly = lambda cs: reduce(lambda high, low: high * x + F.lit(low), reversed(cs[:-1]), F.lit(cs[-1]))
    return poly(coefficients[0]) / poly(coefficients[1])


def density(z: Column) -> Column:
    return F.exp(-z * z / 2) / math.sqrt(2 * math.pi)


def distribution(z: Column) -> Column:
    """P(Z <= z)."""
    x = z / math.sqrt(2)
    size = F.abs(x)
    square = size * size
    inverse = 1 / square
    # exp(-x^2) times a ratio; its form depends on how far out x lies.
    middle = F.exp(-square) * _ratio(size, ERFC_MIDDLE)
    large = F.exp(-square) / size * (1 / math.sqrt(math.pi) - inverse * _ratio(inverse, ERFC_LARGE))
    upper = F.when(size <= MIDDLE_LIMIT, middle).otherwise(large) / 2
    return (
        F.when(size <= SMALL_LIMIT, 0.5 + 0.5 * x * _ratio(square, ERF_SMALL))
        .when(x > 0, 1 - upper).otherwise(upper)
    )


def quantile(p: Column) -> Column:
    """z with P(Z <= z) = p, for p strictly between 0 and 1."""
    q = p - 0.5
    tail = F.sqrt(-F.ln(F.least(p, 1 - p)))
    outer = F.when(tail <= 5.0, _ratio(tail - 1.6, QUANTILE_SHOULDER)).otherwise(_ratio(tail - 5.0, QUANTILE_TAIL))
    return F.when(F.abs(q) <= 0.425, q * _ratio(0.180625 - q * q, QUANTILE_CENTRE)).otherwise(F.signum(q) * outer)


def quantile_of(p: float | Column) -> Column:
    """A literal when the level is a parameter, the expression when it is a column."""
    return quantile(p) if isinstance(p, Column) else F.lit(NormalDist().inv_cdf(p))


def loss(z: Column) -> Column:
    """Expected excess of a standard normal over z."""
    return density(z) - z * (1 - distribution(z))
