"""Normal, Student-t and F distribution functions as Spark column expressions.

Neither Spark SQL nor the SQL oracle has erf, an inverse normal or a t
distribution.  All tails keep their relative precision however small they are
(0 where a double cannot hold them):

* normal: erfc by rational approximations on three ranges (Cody 1969), its
  inverse by three more (Wichura's AS 241): a fixed number of terms in plain
  arithmetic, so they may be evaluated on every data row within codegen;
* Student-t and F: the regularised incomplete beta function.  Its leading
  factor is a binomial density in saddle-point form (deviances and errors of
  Stirling's formula, after Loader), so it keeps its digits for any degrees of
  freedom; the rest is the continued fraction, on the side where it converges,
  with a number of levels bounded by the parameters.  One row per experiment.

``sql_*`` helpers give DuckDB the same functions by other methods: series and
plain continued fractions with log-gamma factors.
"""
from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

_SQRT_2PI = math.sqrt(2.0 * math.pi)

# Cody's rational approximations of erf (|x| <= 0.46875) and erfc (up to 4, above 4).
CODY_P1 = (1.85777706184603153e-1, 3.16112374387056560e+0, 1.13864154151050156e+2, 3.77485237685302021e+2, 3.20937758913846947e+3)
CODY_Q1 = (1.0, 2.36012909523441209e+1, 2.44024637934444173e+2, 1.28261652607737228e+3, 2.84423683343917062e+3)
CODY_P2 = (2.15311535474403846e-8, 5.64188496988670089e-1, 8.88314979438837594e+0, 6.61191906371416295e+1, 2.98635138197400131e+2,
           8.81952221241769090e+2, 1.71204761263407058e+3, 2.05107837782607147e+3, 1.23033935479799725e+3)
CODY_Q2 = (1.0, 1.57449261107098347e+1, 1.17693950891312499e+2, 5.37181101862009858e+2, 1.62138957456669019e+3,
           3.29079923573345963e+3, 4.36261909014324716e+3, 3.43936767414372164e+3, 1.23033935480374942e+3)
CODY_P3 = (1.63153871373020978e-2, 3.05326634961232344e-1, 3.60344899949804439e-1, 1.25781726111229246e-1,
           1.60837851487422766e-2, 6.58749161529837803e-4)
CODY_Q3 = (1.0, 2.56852019228982242e+0, 1.87295284992346725e+0, 5.27905102951428412e-1, 6.05183413124413191e-2,
           2.33520497626869185e-3)
# Wichura's rational approximations of the inverse normal (AS 241), highest power first.
PPND_A = (2.5090809287301226727e+3, 3.3430575583588128105e+4, 6.7265770927008700853e+4, 4.5921953931549871457e+4,
          1.3731693765509461125e+4, 1.9715909503065514427e+3, 1.3314166789178437745e+2, 3.3871328727963666080e+0)
PPND_B = (5.2264952788528545610e+3, 2.8729085735721942674e+4, 3.9307895800092710610e+4, 2.1213794301586595867e+4,
          5.3941960214247511077e+3, 6.8718700749205790830e+2, 4.2313330701600911252e+1, 1.0)
PPND_C = (7.74545014278341407640e-4, 2.27238449892691845833e-2, 2.41780725177450611770e-1, 1.27045825245236838258e+0,
          3.64784832476320460504e+0, 5.76949722146069140550e+0, 4.63033784615654529590e+0, 1.42343711074968357734e+0)
PPND_D = (1.05075007164441684324e-9, 5.47593808499534494600e-4, 1.51986665636164571966e-2, 1.48103976427480074590e-1,
          6.89767334985100004550e-1, 1.67638483018380384940e+0, 2.05319162663775882187e+0, 1.0)
PPND_E = (2.01033439929228813265e-7, 2.71155556874348757815e-5, 1.24266094738807843860e-3, 2.65321895265761230930e-2,
          2.96560571828504891230e-1, 1.78482653991729133580e+0, 5.46378491116411436990e+0, 6.65790464350110377720e+0)
PPND_F = (2.04426310338993978564e-15, 1.42151175831644588870e-7, 1.84631831751005468180e-5, 7.86869131145613259100e-4,
          1.48753612908506148525e-2, 1.36929880922735805310e-1, 5.99832206555887937690e-1, 1.0)
# Acklam's rational approximation of the inverse normal CDF (start of the SQL text's inverse).
ACKLAM_A = (-3.969683028665376e+01, 2.209460984245205e+02, -2.759285104469687e+02,
            1.383577518672690e+02, -3.066479806614716e+01, 2.506628277459239e+00)
ACKLAM_B = (-5.447609879822406e+01, 1.615858368580409e+02, -1.556989798598866e+02,
            6.680131188771972e+01, -1.328068155288572e+01)
ACKLAM_C = (-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e+00,
            -2.549732539343734e+00, 4.374664141464968e+00, 2.938163982698783e+00)
ACKLAM_D = (7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e+00,
            3.754408661907416e+00)
ACKLAM_P_LOW = 0.02425


def _lit(x) -> Column:
    if isinstance(x, Column):
        return x
    if isinstance(x, str):
        return F.col(x)
    return F.lit(float(x))


def _poly(coefs, x: Column) -> Column:
    acc = F.lit(coefs[0])
    for c in coefs[1:]:
        acc = acc * x + F.lit(c)
    return acc


def _let(body: str, **values: Column) -> Column:
    """``body``, SQL text over p.<name>, with each value computed once (a transform of one element).

    Long formulas stay text, so that they cost one call from Python and not
    one for every operator.
    """
    bound = F.array(F.struct(*[v.alias(k) for k, v in values.items()]))
    return F.element_at(F.call_function("transform", bound, F.expr(f"p -> {body}")), 1)


def _bind(body: str, name: str, **values: str) -> str:
    """The same within SQL text: ``body`` over name.<key>."""
    return f"element_at(transform(array(struct({', '.join(f'{v} AS {k}' for k, v in values.items())})), {name} -> {body}), 1)"


# ---- normal ------------------------------------------------------------------

def norm_sf(z) -> Column:
    """P(Z > z) for a standard normal Z."""
    z = _lit(z)
    x = F.abs(z) / math.sqrt(2.0)
    near = 0.5 - 0.5 * x * _poly(CODY_P1, x * x) / _poly(CODY_Q1, x * x)
    # exp(-x^2) in two factors, the first of an exact square
    head = F.floor(F.least(x, F.lit(1e4)) * 16.0) / 16.0
    decay = F.exp(-head * head) * F.exp(-(x - head) * (x + head))
    r = 1.0 / F.greatest(x * x, F.lit(1.0))
    middle = 0.5 * decay * _poly(CODY_P2, x) / _poly(CODY_Q2, x)
    far = 0.5 * decay / F.greatest(x, F.lit(1.0)) * (1.0 / math.sqrt(math.pi) - r * _poly(CODY_P3, r) / _poly(CODY_Q3, r))
    upper = F.when(x <= 0.46875, near).when(x <= 4.0, middle).when(x <= 40.0, far).otherwise(x - x)
    return F.when(z >= 0, upper).otherwise(F.lit(1.0) - upper)


def norm_cdf(z) -> Column:
    return norm_sf(-_lit(z))


def norm_pdf(z) -> Column:
    z = _lit(z)
    return F.exp(-z * z / 2.0) / _SQRT_2PI


def norm_ppf(p) -> Column:
    """Phi^-1(p) for 0 < p < 1 (NULL outside)."""
    p = _lit(p)
    q = p - 0.5
    inner = 0.180625 - q * q
    tail = F.sqrt(-F.log(F.least(p, 1.0 - p)))
    mid = q * _poly(PPND_A, inner) / _poly(PPND_B, inner)
    near = _poly(PPND_C, tail - 1.6) / _poly(PPND_D, tail - 1.6)
    far = _poly(PPND_E, tail - 5.0) / _poly(PPND_F, tail - 5.0)
    out = F.when(tail <= 5.0, near).otherwise(far)
    return F.when((p > 0) & (p < 1), F.when(F.abs(q) <= 0.425, mid).when(q < 0, -out).otherwise(out))


# ---- pieces of gamma functions, as SQL text ---------------------------------------

_SHIFT = 16


def _stirling_error(n: str) -> str:
    """ln n! - (n + 1/2) ln n + n - ln(2 pi) / 2 for real n > 0: the series at n + 16, and a product of 16 factors below 16."""

    def series(x):
        return f"(1D/12 - (1D/360 - (1D/1260 - (1D/1680 - (1D/1188) / ({x} * {x})) / ({x} * {x})) / ({x} * {x})) / ({x} * {x})) / {x}"

    product = " * ".join(f"(s.near + {k}D)" for k in range(1, _SHIFT + 1))
    up = f"(s.near + {_SHIFT}D)"
    low = f"{series(up)} + ({up} + 0.5D) * ln({up}) - {_SHIFT}D - ln({product}) - (s.near + 0.5D) * ln(s.near)"
    return _bind(f"CASE WHEN s.d >= {_SHIFT} THEN {series('s.far')} ELSE {low} END", "s",
                 d=n, far=f"greatest({n}, {_SHIFT}D)", near=f"least(greatest({n}, 1e-300D), {_SHIFT}D)")


def _deviance(x: str, np_: str) -> str:
    """x ln(x / np) + np - x without cancellation, 0 at x = np."""
    terms = f"{1 / 25!r}D"
    for k in range(11, 0, -1):
        terms = f"({terms} * d.v * d.v + 1D/{2 * k + 1})"
    near = f"(d.x - d.np) * d.v + 2 * d.x * d.v * d.v * d.v * {terms}"
    far = "CASE WHEN d.x > 0 THEN d.x * ln(greatest(d.x, 1e-300D) / greatest(d.np, 1e-300D)) ELSE 0D END + d.np - d.x"
    return _bind(f"CASE WHEN abs(d.v) < 0.1 THEN {near} ELSE {far} END", "d",
                 x=x, np=np_, v=f"try_divide({x} - {np_}, {x} + {np_})")


def log_factorial(m) -> Column:
    """ln(m!) for m >= 0 by Stirling's formula and its error term."""
    m = _lit(m)
    body = f"(p.d + 0.5D) * ln(p.d) - p.d + {0.5 * math.log(2.0 * math.pi)!r}D + {_stirling_error('p.d')}"
    return F.when(m <= 1, F.lit(0.0)).otherwise(_let(body, d=F.greatest(m.cast("double"), F.lit(1.0))))


# ---- Student-t and F ------------------------------------------------------------

def _beta_text() -> str:
    """I_x(a, b) over p.a, p.b, p.x, p.y, p.n = a + b, on the side where the fraction converges."""
    # x^a y^b / B(a, b) from the density of "a of a + b" at x
    density = (f"exp({_stirling_error('p.n')} - {_stirling_error('p.a')} - {_stirling_error('p.b')}"
               f" - {_deviance('p.a', '(p.n * p.x)')} - {_deviance('p.b', '(p.n * p.y)')})"
               f" * sqrt(p.n * p.a * p.b / {2.0 * math.pi!r}D) / p.n")
    levels = "CAST(least(4000D, 60D + 2D * sqrt(least(p.a, p.b))) AS INT)"

    # even part of the continued fraction; x and y enter apart, so that neither cancels next to 1
    def term(m):
        return (f"({m} + CASE WHEN {m} > 0 THEN {m} * (p.b - {m}) * p.x / (p.a + 2D * {m} - 1D) ELSE 0D END"
                f" + (p.a + {m}) * (p.a * p.y - p.b * p.x + 1D + {m} * (1D + p.y)) / (p.a + 2D * {m} + 1D))")

    top = "(p.a + i - 1D) * (p.n + i - 1D) * i * (p.b - i) * p.x * p.x / pow(p.a + 2D * i - 1D, 2D)"
    fraction = (f"aggregate(sequence({levels}, 1), CAST({levels} AS DOUBLE), "
                f"(acc, i) -> {term('(i - 1D)')} + {top} / CASE WHEN acc = 0 THEN 1e-300D ELSE acc END)")
    return _bind("CASE WHEN p.swapped THEN 1D - r.part ELSE r.part END", "r", part=f"{density} / {fraction}")


def _beta(a: Column, b: Column, x: Column, y: Column) -> Column:
    """Regularised incomplete beta I_x(a, b) for a, b >= 1/2 and y = 1 - x."""
    swapped = x >= (a + 1.0) / (a + b + 2.0)
    pick = lambda u, v: F.when(swapped, v).otherwise(u)
    inside = _let(_beta_text(), a=pick(a, b), b=pick(b, a), n=a + b, x=pick(x, y), y=pick(y, x), swapped=swapped)
    return F.when(x <= 0, 0.0).when(y <= 0, 1.0).when(a.isNotNull() & b.isNotNull() & x.isNotNull(), inside)


def _real(c) -> Column:
    """A parameter as a double, NULL where it is not a number."""
    c = _lit(c).cast("double")
    return F.when(~F.isnan(c), c)


def t_sf(t, nu) -> Column:
    """P(T > t) for Student's t with ``nu`` >= 1 degrees of freedom (real-valued)."""
    t, nu = _real(t), _real(nu)
    x, y = F.try_divide(nu, nu + t * t), F.try_divide(t * t, nu + t * t)
    tail = 0.5 * _beta(nu / 2.0, F.lit(0.5), x, y)
    return F.when(t >= 0, tail).otherwise(F.lit(1.0) - tail)


def f_sf(f, d1, d2) -> Column:
    """P(F > f) for the F distribution with d1 >= 1 and d2 >= 1 degrees of freedom (real-valued)."""
    f, d1, d2 = _real(f), _real(d1), _real(d2)
    total = d2 + d1 * F.greatest(f, F.lit(0.0))
    upper = _beta(d2 / 2.0, d1 / 2.0, F.try_divide(d2, total), F.try_divide(d1 * f, total))
    return F.when(f <= 0, F.lit(1.0)).otherwise(upper)


def cohens_h(p1, p2) -> Column:
    """2 asin(sqrt(p1)) - 2 asin(sqrt(p2))."""
    return 2.0 * F.asin(F.sqrt(_lit(p1))) - 2.0 * F.asin(F.sqrt(_lit(p2)))


# ---- the same functions as DuckDB SQL text, by other methods -------------------

LEVELS = 600                     # of the continued fractions


def _d(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def _sql_fraction(body: str, start: str = "1.0") -> str:
    """Continued fraction from the innermost level outwards; ``body`` maps acc and the level i."""
    return f"list_reduce(list_prepend({start}, list_transform(range({LEVELS}, 0, -1), lambda j: CAST(j AS DOUBLE))), " \
           f"lambda acc, i: {body})"


def sql_norm_sf(z: str) -> str:
    """Power series below 2.5, Laplace's continued fraction above."""
    z = _d(z)
    x = f"abs({z})"
    terms = f"list_transform(range(0, 60), lambda k: exp((2 * k + 1) * ln({x}) - (k + 1) * ln(2.0) - lgamma(k + 1.5)))"
    series = f"(CASE WHEN {x} = 0 THEN 0.5 ELSE 0.5 - {sql_norm_pdf(z)} * sqrt(pi()) * list_sum({terms}) END)"
    fraction = f"({sql_norm_pdf(z)} / {_sql_fraction(f'{x} + i / acc', x)})"
    upper = f"(CASE WHEN {x} < 2.5 THEN {series} ELSE {fraction} END)"
    return f"(CASE WHEN ({z}) >= 0 THEN {upper} ELSE 1.0 - {upper} END)"


def _sql_beta(a: str, b: str, x: str, y: str) -> str:
    """Regularised incomplete beta I_x(a, b), y = 1 - x, by its continued fraction (on the side where it converges)."""
    def side(a, b, x, y):
        even = f"(floor(i / 2) * ({b} - floor(i / 2)) * {x} / (({a} + i - 1) * ({a} + i)))"
        odd = f"(-({a} + floor(i / 2)) * ({a} + {b} + floor(i / 2)) * {x} / (({a} + i - 1) * ({a} + i)))"
        front = f"exp({a} * ln({x}) + {b} * ln({y}) + lgamma({a} + {b}) - lgamma({a}) - lgamma({b})) / {a}"
        return f"({front} / {_sql_fraction(f'1.0 + (CASE WHEN i % 2 = 0 THEN {even} ELSE {odd} END) / acc')})"
    return f"(CASE WHEN {x} <= 0 THEN 0.0 WHEN {y} <= 0 THEN 1.0 " \
           f"WHEN {x} < ({a} + 1) / ({a} + {b} + 2) THEN {side(a, b, x, y)} ELSE 1.0 - {side(b, a, y, x)} END)"


def sql_norm_cdf(z: str) -> str:
    return sql_norm_sf(f"(-({z}))")


def sql_norm_pdf(z: str) -> str:
    z = _d(z)
    return f"(exp(-({z}) * ({z}) / 2.0) / {_SQRT_2PI!r})"


def _sql_poly(coefs, x: str) -> str:
    acc = repr(coefs[0])
    for c in coefs[1:]:
        acc = f"({acc} * ({x}) + {c!r})"
    return acc


def _sql_acklam(p: str) -> str:
    ql = f"sqrt(-2.0 * ln({p}))"
    qh = f"sqrt(-2.0 * ln(1.0 - ({p})))"
    q = f"(({p}) - 0.5)"
    r = f"({q} * {q})"
    low = f"({_sql_poly(ACKLAM_C, ql)} / ({_sql_poly(ACKLAM_D, ql)} * {ql} + 1.0))"
    high = f"(-{_sql_poly(ACKLAM_C, qh)} / ({_sql_poly(ACKLAM_D, qh)} * {qh} + 1.0))"
    mid = f"({_sql_poly(ACKLAM_A, r)} * {q} / ({_sql_poly(ACKLAM_B, r)} * {r} + 1.0))"
    return f"(CASE WHEN ({p}) < {ACKLAM_P_LOW} THEN {low} WHEN ({p}) > {1.0 - ACKLAM_P_LOW!r} THEN {high} " \
           f"ELSE {mid} END)"


def sql_norm_ppf(p: str) -> str:
    p = _d(p)
    x0 = _sql_acklam(p)
    refined = f"({x0} - ({sql_norm_cdf(x0)} - ({p})) / {sql_norm_pdf(x0)})"
    return f"(CASE WHEN ({p}) > 0 AND ({p}) < 1 THEN {refined} END)"


def sql_t_sf(t: str, nu: str) -> str:
    t, nu = _d(t), _d(nu)
    tail = f"(0.5 * {_sql_beta(f'({nu} / 2)', '0.5', f'({nu} / ({nu} + {t} * {t}))', f'({t} * {t} / ({nu} + {t} * {t}))')})"
    return f"(CASE WHEN ({t}) >= 0 THEN {tail} ELSE 1.0 - {tail} END)"


def sql_cohens_h(p1: str, p2: str) -> str:
    return f"(2.0 * asin(sqrt({p1})) - 2.0 * asin(sqrt({p2})))"


# ---- hypergeometric terms ---------------------------------------------------

def _log_binomial(x: str, n: str, q: str) -> str:
    """ln of the binomial probability of x in n (saddle-point form), for 0 <= q <= 1."""
    inside = (f"{_stirling_error(n)} - {_stirling_error(x)} - {_stirling_error(f'({n} - {x})')}"
              f" - {_deviance(x, f'({n} * {q})')} - {_deviance(f'({n} - {x})', f'({n} * (1D - {q}))')}"
              f" + 0.5D * ln(greatest({n}, 1D) / ({2.0 * math.pi!r}D * greatest({x}, 1D) * greatest({n} - {x}, 1D)))")
    return (f"CASE WHEN {n} = 0 THEN 0D WHEN {x} = 0 THEN {n} * log1p(-least({q}, {1.0 - 1e-16!r}D)) "
            f"WHEN {x} = {n} THEN {n} * ln(greatest({q}, 1e-300D)) ELSE {inside} END")


def log_hypergeometric(x: Column, n_t: Column, n_c: Column, k: Column) -> Column:
    """ln P(x of k successes fall in n_t of n_t + n_c units), as three binomials with probability k / N."""
    d = {n: c.cast("double") for n, c in (("x", x), ("t", n_t), ("c", n_c), ("k", k))}
    body = (f"{_log_binomial('p.x', 'p.t', 'p.q')} + {_log_binomial('(p.k - p.x)', 'p.c', 'p.q')}"
            f" - {_log_binomial('p.k', '(p.t + p.c)', 'p.q')}")
    return _let(body, **d, q=F.try_divide(d["k"], d["t"] + d["c"]))


def sql_f_sf(f: str, d1: str, d2: str) -> str:
    f, d1, d2 = _d(f), _d(d1), _d(d2)
    total = f"({d2} + {d1} * {f})"
    return f"(CASE WHEN {f} <= 0 THEN 1.0 ELSE " \
           f"{_sql_beta(f'({d2} / 2)', f'({d1} / 2)', f'({d2} / {total})', f'({d1} * {f} / {total})')} END)"


def sql_log_factorial(m: str) -> str:
    md = f"CAST({m} AS DOUBLE)"
    exact = f"list_reduce(list_transform(range(1, greatest(CAST({m} AS BIGINT), 1) + 1), " \
            f"lambda i: ln(CAST(i AS DOUBLE))), lambda x, y: x + y)"
    stirling = f"({md} * ln({md}) - {md} + 0.5 * ln(2.0 * pi() * {md}) + 1.0 / (12.0 * {md}) " \
               f"- 1.0 / (360.0 * pow({md}, 3)) + 1.0 / (1260.0 * pow({md}, 5)) - 1.0 / (1680.0 * pow({md}, 7)))"
    return f"(CASE WHEN {m} <= 1 THEN 0.0 WHEN {m} < 20 THEN {exact} ELSE {stirling} END)"
