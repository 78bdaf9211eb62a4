"""The same results in plain SQL, for comparison on another engine."""

from __future__ import annotations

from math import exp, factorial, floor

from touchline.binding import AS_OF, CLUBS, CUTOFF, LINKED, ORIGINS, on_matches

LOOKUP = """
lookup(league_name, country) AS (
  VALUES ('Division A', 'Homeland'), ('Division B', 'Homeland'), ('Division C', 'Homeland'))
"""
SCOPED = "league IN ('Division A', 'Division B', 'Division C')"

SEASON = """CASE WHEN month(match_date) >= 7 THEN concat(year(match_date), '/', year(match_date) + 1)
         ELSE concat(year(match_date) - 1, '/', year(match_date)) END"""

FACT = f"""
fact AS (
  SELECT match_id AS match_key, upper(home_team) AS home_team_key, upper(away_team) AS away_team_key,
    CAST(strftime(match_date, '%Y%m%d') AS INT) AS date_key, upper(league) AS league_key,
    {SEASON} AS season_key,
    home_goals, away_goals, result, crowd_1, crowd_x, crowd_2, odds_1, odds_x, odds_2,
    start_odds_1, start_odds_x, start_odds_2, favourite_odds_1, favourite_odds_x, favourite_odds_2,
    status, betradar_id, CAST(NULL AS DOUBLE) AS calibrated_1, CAST(NULL AS DOUBLE) AS calibrated_x,
    CAST(NULL AS DOUBLE) AS calibrated_2, CAST(NULL AS DOUBLE) AS elo_home, CAST(NULL AS DOUBLE) AS elo_away
  FROM matches WHERE {SCOPED})
"""

CHEAP = """
cheap AS (
  SELECT *, CAST(1400 + match_id * 37 % 200 AS DOUBLE) AS elo_home,
         CAST(1400 + match_id * 53 % 200 AS DOUBLE) AS elo_away FROM matches),
expected AS (
  SELECT *, 1.0 / (1.0 + pow(10.0, (elo_away - (elo_home + 65.0)) / 400.0)) AS e FROM cheap)
"""

TEAMS = """
sides AS (
  SELECT match_start, match_id, 0 AS side, home_team AS team_name, home_team_id AS team_id,
         home_team_country AS country FROM matches
  UNION ALL
  SELECT match_start, match_id, 1, away_team, away_team_id, away_team_country FROM matches),
teams AS (
  SELECT upper(team_name) AS team_key, team_name, team_id, country FROM sides
  QUALIFY row_number() OVER (PARTITION BY upper(team_name)
                             ORDER BY match_start DESC, match_id DESC, side) = 1)
"""

DATES = f"""
dates AS (
  SELECT CAST(d AS DATE) AS full_date, CAST(strftime(d, '%Y%m%d') AS INT) AS date_key,
    CAST(year(d) AS INT) AS year, CAST(quarter(d) AS INT) AS quarter, CAST(month(d) AS INT) AS month,
    strftime(d, '%B') AS month_name, CAST(day(d) AS INT) AS day, CAST(isodow(d) AS INT) AS day_of_week,
    strftime(d, '%A') AS day_name, CAST(week(d) AS INT) AS week_of_year, isodow(d) >= 6 AS is_weekend
  FROM (SELECT unnest(generate_series(CAST(min(match_date) AS TIMESTAMP),
                                      CAST(DATE '{AS_OF}' + 730 AS TIMESTAMP), INTERVAL 1 DAY)) AS d
        FROM matches))
"""

# A fold over the matches of each pool of forty teams in order, all pools in step; the state is
# the list of a pool's ratings.
ELO = """
seq AS MATERIALIZED (
  SELECT pool, row_number() OVER (PARTITION BY pool ORDER BY match_date, match_id) AS n, match_id,
    CAST(home % 40 + 1 AS INT) AS h, CAST(away % 40 + 1 AS INT) AS a,
    CASE result WHEN '1' THEN 1.0 WHEN 'X' THEN 0.5 WHEN '2' THEN 0.0 END AS points
  FROM (SELECT *, CAST(substr(home_team, 6) AS BIGINT) AS home, CAST(substr(away_team, 6) AS BIGINT) AS away,
          CAST(substr(home_team, 6) AS BIGINT) // 40 AS pool FROM matches)),
fold AS (
  SELECT DISTINCT pool, CAST(0 AS BIGINT) AS n, CAST(NULL AS BIGINT) AS match_id, CAST(NULL AS DOUBLE) AS elo_home,
    CAST(NULL AS DOUBLE) AS elo_away,
    list_transform(generate_series(1, 40), lambda v: CAST(1500 AS DOUBLE)) AS ratings FROM seq
  UNION ALL
  SELECT q.pool, q.n, q.match_id, f.ratings[q.h], f.ratings[q.a],
    CASE WHEN q.points IS NULL THEN f.ratings ELSE
      list_transform(f.ratings, lambda v, i:
        CASE WHEN i = q.h THEN v + 20.0 * (CAST(q.points AS DOUBLE)
               - 1.0 / (1.0 + pow(10.0, (f.ratings[q.a] - (f.ratings[q.h] + 65.0)) / 400.0)))
             WHEN i = q.a THEN v - 20.0 * (CAST(q.points AS DOUBLE)
               - 1.0 / (1.0 + pow(10.0, (f.ratings[q.a] - (f.ratings[q.h] + 65.0)) / 400.0)))
             ELSE v END) END
  FROM fold f JOIN seq q ON q.pool = f.pool AND q.n = f.n + 1),
elo AS (SELECT match_id, elo_home, elo_away FROM fold WHERE n > 0)
"""

# The same over one sequence of linked clubs.
ELO_LINKED = (
    ELO.replace("CAST(home % 40 + 1 AS INT) AS h, CAST(away % 40 + 1 AS INT) AS a,", "h + 1 AS h, a + 1 AS a,")
    .replace(
        """(SELECT *, CAST(substr(home_team, 6) AS BIGINT) AS home, CAST(substr(away_team, 6) AS BIGINT) AS away,
          CAST(substr(home_team, 6) AS BIGINT) // 40 AS pool FROM matches)""",
        "(SELECT *, 0 AS pool FROM linked)",
    )
    .replace("generate_series(1, 40)", f"generate_series(1, {CLUBS})")
)

# Isotonic regression by its max-min formula over segment means, read between the points by
# straight lines.
CURVE = """
hits AS (
  SELECT '1' AS outcome, crowd_1 AS x, CAST(result = '1' AS INT) AS y FROM matches WHERE result IS NOT NULL
  UNION ALL SELECT 'X', crowd_x, CAST(result = 'X' AS INT) FROM matches WHERE result IS NOT NULL
  UNION ALL SELECT '2', crowd_2, CAST(result = '2' AS INT) FROM matches WHERE result IS NOT NULL),
points AS (SELECT outcome, x, sum(y) AS h, count(*) AS n FROM hits GROUP BY outcome, x),
sums AS (
  SELECT outcome, x, h, n, row_number() OVER w AS i, sum(h) OVER w AS ch, sum(n) OVER w AS cn
  FROM points WINDOW w AS (PARTITION BY outcome ORDER BY x)),
segments AS (
  SELECT a.outcome, a.i AS lo, b.i AS hi,
    CAST(b.ch - a.ch + a.h AS DOUBLE) / CAST(b.cn - a.cn + a.n AS DOUBLE) AS mean
  FROM sums a JOIN sums b ON a.outcome = b.outcome AND a.i <= b.i),
lowest AS (
  SELECT outcome, lo, hi, min(mean) OVER (PARTITION BY outcome, lo ORDER BY hi DESC) AS m FROM segments),
curve AS (
  SELECT s.outcome, s.x, max(l.m) AS v FROM sums s
  JOIN lowest l ON l.outcome = s.outcome AND l.hi = s.i GROUP BY s.outcome, s.x),
asked AS (
  SELECT DISTINCT '1' AS outcome, crowd_1 AS x FROM matches
  UNION SELECT 'X', crowd_x FROM matches UNION SELECT '2', crowd_2 FROM matches),
around AS (
  SELECT q.outcome, q.x, max(CASE WHEN c.x <= q.x THEN c.x END) AS x0, min(CASE WHEN c.x >= q.x THEN c.x END) AS x1
  FROM asked q JOIN curve c ON c.outcome = q.outcome GROUP BY q.outcome, q.x),
fitted AS (
  SELECT r.outcome, r.x, CASE WHEN r.x0 IS NULL THEN u.v WHEN r.x1 IS NULL OR r.x0 = r.x1 THEN l.v
         ELSE l.v + (u.v - l.v) * (r.x - r.x0) / (r.x1 - r.x0) END AS v
  FROM around r LEFT JOIN curve l ON l.outcome = r.outcome AND l.x = r.x0
  LEFT JOIN curve u ON u.outcome = r.outcome AND u.x = r.x1),
calibrated AS (
  SELECT m.*, f1.v / (f1.v + fx.v + f2.v) AS calibrated_1, fx.v / (f1.v + fx.v + f2.v) AS calibrated_x,
    f2.v / (f1.v + fx.v + f2.v) AS calibrated_2
  FROM matches m JOIN fitted f1 ON f1.outcome = '1' AND f1.x = m.crowd_1
  JOIN fitted fx ON fx.outcome = 'X' AND fx.x = m.crowd_x
  JOIN fitted f2 ON f2.outcome = '2' AND f2.x = m.crowd_2)
"""

# Isotonic regression over many distinct points: a fold over the points in order, whose state
# is the stack of blocks; each step takes the next point or merges the two last blocks.
RATING_CURVE = """
rated AS MATERIALIZED (
  SELECT e.match_id, m.result,
    1.0 / (1.0 + pow(CAST(10.0 AS DOUBLE), -(e.elo_home + 65.0 - e.elo_away) / 400.0)) AS e
  FROM elo e JOIN matches m ON m.match_id = e.match_id),
signals AS MATERIALIZED (
  SELECT match_id, '1' AS outcome, e AS x, CAST(result = '1' AS BIGINT) AS y FROM rated
  UNION ALL SELECT match_id, 'X', CAST(0.5 AS DOUBLE) - abs(e - CAST(0.5 AS DOUBLE)), CAST(result = 'X' AS BIGINT) FROM rated
  UNION ALL SELECT match_id, '2', CAST(1.0 AS DOUBLE) - e, CAST(result = '2' AS BIGINT) FROM rated),
points AS MATERIALIZED (
  SELECT outcome, x, CAST(sum(y) AS BIGINT) AS h, count(*) AS n, row_number() OVER (PARTITION BY outcome ORDER BY x) AS i
  FROM signals WHERE y IS NOT NULL GROUP BY outcome, x),
stack AS (
  SELECT DISTINCT outcome, CAST(0 AS BIGINT) AS i, CAST([] AS BIGINT[]) AS hs, CAST([] AS BIGINT[]) AS ns,
    CAST([] AS BIGINT[]) AS cs FROM points
  UNION ALL
  SELECT outcome, CASE WHEN merging THEN i ELSE i + 1 END,
    CASE WHEN merging THEN list_append(hs[:-3], hs[-2] + hs[-1]) ELSE list_append(hs, h) END,
    CASE WHEN merging THEN list_append(ns[:-3], ns[-2] + ns[-1]) ELSE list_append(ns, n) END,
    CASE WHEN merging THEN list_append(cs[:-3], cs[-2] + cs[-1]) ELSE list_append(cs, 1) END
  FROM (SELECT s.*, q.h, q.n, len(s.hs) > 1 AND s.hs[-2] * s.ns[-1] >= s.hs[-1] * s.ns[-2] AS merging
        FROM stack s LEFT JOIN points q ON q.outcome = s.outcome AND q.i = s.i + 1)
  WHERE merging OR n IS NOT NULL),
settled AS (
  SELECT * FROM stack QUALIFY row_number() OVER (PARTITION BY outcome ORDER BY i DESC, len(hs)) = 1),
blocks AS (
  SELECT outcome, unnest(hs) AS h, unnest(ns) AS n, unnest(cs) AS c, unnest(range(len(hs))) AS b FROM settled),
placed AS (
  SELECT outcome, CAST(h AS DOUBLE) / CAST(n AS DOUBLE) AS v,
    sum(c) OVER (PARTITION BY outcome ORDER BY b) - c + 1 AS first, sum(c) OVER (PARTITION BY outcome ORDER BY b) AS last
  FROM blocks),
curve AS (
  SELECT p.outcome, p.x, b.v FROM points p JOIN placed b ON b.outcome = p.outcome AND p.i BETWEEN b.first AND b.last),
below AS (
  SELECT s.match_id, s.outcome, s.x, c.x AS x0, c.v AS v0
  FROM signals s ASOF LEFT JOIN curve c ON c.outcome = s.outcome AND s.x >= c.x),
fitted AS (
  SELECT s.match_id, s.outcome, CASE WHEN s.x0 IS NULL THEN c.v WHEN c.x IS NULL OR s.x0 = c.x THEN s.v0
         ELSE s.v0 + (c.v - s.v0) * (s.x - s.x0) / (c.x - s.x0) END AS v
  FROM below s ASOF LEFT JOIN curve c ON c.outcome = s.outcome AND s.x <= c.x),
chances AS (
  SELECT match_id, max(v) FILTER (WHERE outcome = '1') AS p1, max(v) FILTER (WHERE outcome = 'X') AS px,
    max(v) FILTER (WHERE outcome = '2') AS p2 FROM fitted GROUP BY match_id)
"""

MART = f"""
{CURVE.strip()},
{ELO.strip()},
mart AS (
  SELECT c.round_number, c.event_number, c.match_id AS match_key, c.match_start, c.home_team, c.away_team,
    c.league, c.status, c.crowd_1, c.crowd_x, c.crowd_2, c.calibrated_1, c.calibrated_x, c.calibrated_2,
    e.elo_home, e.elo_away, 1.0 / (1.0 + pow(10.0, (e.elo_away - (e.elo_home + 65.0)) / 400.0)) AS elo_expected_score,
    DATE '{AS_OF}' AS scored_at
  FROM calibrated c LEFT JOIN elo e ON e.match_id = c.match_id
  WHERE c.round_number = (SELECT max(round_number) FROM matches))
"""


def _brier(prefix: str) -> str:
    terms = [
        f"pow({prefix}_{s} - CASE WHEN result = '{v}' THEN 1.0 ELSE 0.0 END, 2)"
        for s, v in (("1", "1"), ("x", "X"), ("2", "2"))
    ]
    return f"(({' + '.join(terms)}) / 3.0)"


EVEN = """
judged AS (
  SELECT *, CAST(1.0 AS DOUBLE) / 3.0 AS even_1, CAST(1.0 AS DOUBLE) / 3.0 AS even_x,
    CAST(1.0 AS DOUBLE) / 3.0 AS even_2 FROM matches WHERE result IS NOT NULL)
"""


def _pairs() -> str:
    pairs = (("even", "crowd"), ("even", "favourite_odds"), ("crowd", "favourite_odds"))
    gains = " UNION ALL ".join(
        f"SELECT '{b}' AS baseline, '{c}' AS candidate, {_brier(b)} - {_brier(c)} AS gain FROM judged"
        for b, c in pairs
    )
    return f"""
gains AS ({gains}),
moments AS (
  SELECT baseline, candidate, avg(gain) AS mean_difference, stddev_samp(gain) AS sd, count(gain) AS n
  FROM gains GROUP BY baseline, candidate),
pairs AS (
  SELECT *, CASE WHEN sd > 0 THEN sd / sqrt(n) END AS standard_error FROM moments),
paired AS (
  SELECT *, mean_difference / standard_error AS t_statistic, mean_difference - 1.96 * standard_error AS ci_low,
    mean_difference + 1.96 * standard_error AS ci_high FROM pairs)
"""


def _calibration_metrics() -> str:
    rows = []
    for kind, prefix in (("raw", "crowd"), ("calibrated", "calibrated")):
        errors = {
            v: f"avg(CASE WHEN result IS NOT NULL THEN pow({prefix}_{s} - CASE WHEN result = '{v}' THEN 1.0 ELSE 0.0 END, 2) END)"
            for s, v in (("1", "1"), ("x", "X"), ("2", "2"))
        }
        rows += [f"SELECT 'brier_{kind}_{v}' AS metric, round({e}, 8) AS value FROM calibrated" for v, e in errors.items()]
        pooled = " + ".join(errors.values())
        rows.append(f"SELECT 'brier_{kind}_pooled', round(({pooled}) / 3.0, 8) FROM calibrated")
    rows.append("SELECT 'rows', CAST(count(*) AS DOUBLE) FROM calibrated")
    return " UNION ALL ".join(rows)


def _logit(column: str) -> str:
    p = f"least(greatest({column}, 1e-6), CAST(1.0 AS DOUBLE) - 1e-6)"
    return f"ln({p} / (1.0 - {p}))"


def _logit_features() -> str:
    parts = ["match_id"]
    for source in ("crowd", "favourite_odds"):
        parts += [f"round({_logit(f'{source}_{s}')}, 6) AS logit_{source}_{s}" for s in ("1", "x", "2")]
    safe = [f"least(greatest(crowd_{s}, 1e-6), CAST(1.0 AS DOUBLE))" for s in ("1", "x", "2")]
    entropy = "(-(" + " + ".join(f"{p} * ln({p})" for p in safe) + ") / ln(3.0))"
    parts += [
        f"round({_logit(f'favourite_odds_{s}')} * {entropy}, 6) AS interaction_{s}" for s in ("1", "x", "2")
    ]
    return f"SELECT {', '.join(parts)} FROM matches"


def _blend_grid() -> str:
    terms = " + ".join(
        f"pow(w * crowd_{s} + (1.0 - w) * even_{s} - CASE WHEN result = '{v}' THEN 1.0 ELSE 0.0 END, 2)"
        for s, v in (("1", "1"), ("x", "X"), ("2", "2"))
    )
    return f"""
, {EVEN.strip()},
weights AS (SELECT CAST(step AS DOUBLE) / 20.0 AS w FROM generate_series(0, 20) AS g(step))
SELECT round(w, 8) AS weight, round(avg(({terms}) / 3.0), 8) AS brier
FROM judged CROSS JOIN weights GROUP BY w ORDER BY avg(({terms}) / 3.0), w LIMIT 1
"""


ROUNDS = "SELECT DISTINCT round_number FROM matches WHERE league ="
PLAN = f"""
plan AS (
  SELECT CAST(i AS BIGINT) AS round_number,
    CASE WHEN i NOT IN ({ROUNDS} 'Division A') THEN 'load'
         WHEN i > (SELECT max(round_number) FROM matches) - 2 THEN 'refresh' ELSE 'skip' END AS action
  FROM (SELECT unnest(generate_series(0, (SELECT max(round_number) FROM matches))) AS i))
"""

def _rolling() -> str:
    """The curve of each origin from the matches before it, judged on those until the next."""
    judged = []
    for origin, end in zip(ORIGINS, [*ORIGINS[1:], "9999-12-31"], strict=True):
        curve = CURVE.strip().replace("WHERE result IS NOT NULL", f"WHERE result IS NOT NULL AND match_date < DATE '{origin}'")
        body = (
            f", {curve} SELECT '{origin}' AS origin, {_brier('crowd')} AS crowd, {_brier('calibrated')} AS calibrated "
            f"FROM calibrated WHERE result IS NOT NULL AND match_date >= DATE '{origin}' AND match_date < DATE '{end}'"
        )
        judged.append(f"SELECT * FROM ({on_matches(body)})")
    numbers = (
        "count(*) AS matches, round(avg(crowd), 6) AS brier_crowd, round(avg(calibrated), 6) AS brier_calibrated, "
        "round(avg(crowd - calibrated), 6) AS gain FROM judged"
    )
    return (
        f"WITH judged AS ({' UNION ALL '.join(judged)}) "
        f"SELECT origin, {numbers} GROUP BY origin UNION ALL SELECT 'all', {numbers}"
    )


def _origin_windows() -> list[tuple[str, str]]:
    return list(zip(ORIGINS, [*ORIGINS[1:], "9999-12-31"], strict=True))


def _forecasts(origin: str, end: str) -> str:
    """Every forecast that needs no solver, learned before ``origin``, of the matches until ``end``."""
    before = f"match_date < DATE '{origin}'"
    curve = CURVE.strip().replace("WHERE result IS NOT NULL", f"WHERE result IS NOT NULL AND {before}")
    chances = RATING_CURVE.strip().replace("e.match_id, m.result,", f"e.match_id, CASE WHEN m.{before} THEN m.result END AS result,")

    def mix(name: str, weight: str) -> str:
        return ", ".join(f"{weight} * calibrated_{s} + (1.0 - {weight}) * elo_{s} AS {name}_{s}" for s in "1x2")

    third = ", ".join(f"CAST(1.0 AS DOUBLE) / 3.0 AS even_{s}" for s in "1x2")
    body = f"""
, cal AS (WITH {curve} SELECT match_id, calibrated_1, calibrated_x, calibrated_2 FROM calibrated),
cheap AS (
  SELECT match_id, CAST(1400 + match_id * 37 % 200 AS DOUBLE) AS elo_home, CAST(1400 + match_id * 53 % 200 AS DOUBLE) AS elo_away
  FROM matches),
chance AS (
  WITH RECURSIVE elo AS (SELECT * FROM cheap), {chances}
  SELECT match_id, p1 / (p1 + px + p2) AS elo_1, px / (p1 + px + p2) AS elo_x, p2 / (p1 + px + p2) AS elo_2 FROM chances),
told AS MATERIALIZED (
  SELECT * FROM (SELECT match_id, match_date, result, crowd_1, crowd_x, crowd_2 FROM matches WHERE result IS NOT NULL)
  JOIN cal USING (match_id) JOIN chance USING (match_id)),
tried AS (
  SELECT w, {mix('tried', 'w')}, result FROM told, (SELECT CAST(unnest(range(21)) AS DOUBLE) / 20.0 AS w) WHERE {before}),
best AS (SELECT w FROM (SELECT w, avg({_brier('tried')}) AS score FROM tried GROUP BY w) ORDER BY score, w LIMIT 1)
SELECT '{origin}' AS origin, *, {third}, {mix('halves', '0.5')}, {mix('best_mix', 'w')}
FROM told, best WHERE match_date >= DATE '{origin}' AND match_date < DATE '{end}'"""
    return on_matches(body)


def _rolling_pairs() -> str:
    pairs = (("even", "crowd"), ("crowd", "calibrated"), ("calibrated", "elo"), ("calibrated", "halves"), ("calibrated", "best_mix"))
    scored = " UNION ALL BY NAME ".join(f"SELECT * FROM ({_forecasts(*window)})" for window in _origin_windows())
    gains = " UNION ALL ".join(
        f"SELECT origin, '{b}' AS baseline, '{c}' AS candidate, {_brier(b)} - {_brier(c)} AS gain FROM scored" for b, c in pairs
    )
    keys = "baseline, candidate"
    return f"""
WITH scored AS MATERIALIZED ({scored}),
gains AS MATERIALIZED ({gains}),
means AS (SELECT {keys}, avg(gain) AS mean_difference FROM gains GROUP BY {keys}),
apart AS (
  SELECT origin, {keys}, mean_difference, count(gain) AS n, sum(gain - mean_difference) AS e
  FROM gains JOIN means USING ({keys}) GROUP BY origin, {keys}, mean_difference),
cells AS (
  SELECT origin, {keys}, avg(gain) AS mean_difference, count(gain) AS n, CAST(1 AS BIGINT) AS clusters,
    stddev_samp(gain) / sqrt(count(gain)) AS error FROM gains GROUP BY origin, {keys}
  UNION ALL
  SELECT 'all', {keys}, mean_difference, CAST(sum(n) AS BIGINT), count(*),
    sqrt(count(*) / (count(*) - 1.0) * sum(e * e)) / sum(n) FROM apart GROUP BY {keys}, mean_difference),
sure AS (SELECT * EXCLUDE (error), CASE WHEN error > 0 THEN error END AS standard_error FROM cells)
SELECT origin, {keys}, round(mean_difference, 7) AS mean_difference, n, clusters, round(standard_error, 7) AS standard_error,
  round(mean_difference / standard_error, 4) AS t_statistic, round(mean_difference - 1.96 * standard_error, 7) AS ci_low,
  round(mean_difference + 1.96 * standard_error, 7) AS ci_high FROM sure"""


def _simultaneous(draws: int = 64) -> str:
    """Resamples whose counts are read from a hash of the match and the draw, 16 bits a count."""
    origin = "CASE " + " ".join(f"WHEN match_date >= DATE '{o}' THEN '{o}'" for o in reversed(ORIGINS)) + " END"
    limits = [floor(65536 * sum(exp(-1) / factorial(j) for j in range(k + 1))) for k in range(8)]
    times = " + ".join(f"CAST(u >= {limit} AS INT)" for limit in limits)
    pairs = (("even", "crowd"), ("even", "favourite_odds"), ("crowd", "favourite_odds"))
    gains = " UNION ALL ".join(
        f"SELECT match_id, {origin} AS origin, '{b}' AS baseline, '{c}' AS candidate, {_brier(b)} - {_brier(c)} AS gain FROM judged"
        for b, c in pairs
    )
    return on_matches(f"""
, {EVEN.strip()},
gains AS MATERIALIZED (SELECT * FROM ({gains}) WHERE origin IS NOT NULL),
cells AS MATERIALIZED (
  SELECT origin, baseline, candidate, avg(gain) AS mean_difference, count(gain) AS n,
    CASE WHEN stddev_samp(gain) > 0 THEN stddev_samp(gain) / sqrt(count(gain)) END AS standard_error
  FROM gains GROUP BY origin, baseline, candidate),
numbers AS (
  SELECT match_id, draw, CAST(concat('0x', substr(md5(concat(match_id, '|', draw // 8)), draw % 8 * 4 + 1, 4)) AS BIGINT) AS u
  FROM (SELECT DISTINCT match_id FROM gains), (SELECT unnest(range({draws})) AS draw)),
counts AS (SELECT match_id, draw, {times} AS times FROM numbers),
redrawn AS (
  SELECT draw, origin, baseline, candidate, sum(times * gain) / sum(times) AS redrawn
  FROM gains JOIN counts USING (match_id) WHERE times > 0 GROUP BY draw, origin, baseline, candidate),
largest AS (
  SELECT draw, max(abs(redrawn - mean_difference) / standard_error) AS largest
  FROM redrawn JOIN cells USING (origin, baseline, candidate) GROUP BY draw),
ranked AS (SELECT largest, row_number() OVER (ORDER BY largest) AS place, count(*) OVER () AS n FROM largest),
limits AS (SELECT min(largest) AS critical FROM ranked WHERE place >= 0.95 * n),
bounds AS (
  SELECT *, mean_difference - critical * standard_error AS low, mean_difference + critical * standard_error AS high FROM cells, limits)
SELECT origin, baseline, candidate, round(mean_difference, 7) AS mean_difference, n, round(standard_error, 7) AS standard_error,
  round(critical, 4) AS critical, round(mean_difference / standard_error, 4) AS t_statistic, round(low, 7) AS ci_low,
  round(high, 7) AS ci_high,
  CASE WHEN low > 0 THEN 'better' WHEN high < 0 THEN 'worse' ELSE 'no measurable difference' END AS verdict FROM bounds""")


def _flat(interaction: bool) -> str:
    """No slope is left in any coefficient of a fitted pool."""
    names = ["intercept", *(f"logit_{source}_{s}" for source in ("crowd", "elo") for s in "1x2")]
    names += [f"interaction_{s}" for s in "1x2"] if interaction else []
    rows = ", ".join(f"('{label}', '{name}', CAST(0 AS DOUBLE))" for label in "1X2" for name in names)
    return f"SELECT * FROM (VALUES {rows}) AS t(class, feature, slope)"


ORACLES: dict[str, str] = {
    "scan_table": "SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice FROM lineitem",
    "inline_relation": on_matches(
        f", {LOOKUP.strip()} SELECT league_name AS league, country, count(*) AS matches FROM lookup "
        "JOIN matches ON league = league_name GROUP BY league_name, country"
    ),
    "ingest_plan": on_matches(f", {PLAN.strip()} SELECT * FROM plan"),
    "ingest_audit": on_matches(
        f", {PLAN.strip()} SELECT CASE WHEN action = 'skip' THEN 'skipped' "
        f"WHEN round_number IN ({ROUNDS} 'Cup') THEN 'fetched' ELSE 'failed' END AS status, "
        "count(*) AS documents FROM plan GROUP BY 1"
    ),
    "overwrite_roundtrip": on_matches(f", {TEAMS.strip()} SELECT * FROM teams"),
    "merge_update_matched": on_matches(
        f", {FACT.strip()} SELECT match_key, league_key, result, "
        "CASE WHEN result IS NULL THEN 1500.0 WHEN result <> 'X' THEN CAST(1400 + match_key * 37 % 200 AS DOUBLE) END AS elo_home, "
        "CASE WHEN result IS NULL THEN 1500.0 ELSE CAST(1400 + match_key * 53 % 200 AS DOUBLE) END AS elo_away FROM fact"
    ),
    "upsert_wildcard": on_matches("""
SELECT match_id AS match_key, round_number,
  round(CASE WHEN match_date >= DATE '1999-07-01' THEN crowd_1 + crowd_x ELSE crowd_1 END, 6) AS crowd_1,
  CASE WHEN match_date >= DATE '1999-07-01' THEN result ELSE status END AS status,
  round(CASE WHEN match_date >= DATE '1999-07-01' THEN crowd_2 END, 6) AS crowd_2
FROM matches"""),
    "update_one_season": on_matches(
        f", {FACT.strip()} SELECT season_key, count(*) AS matches, "
        "sum(CASE WHEN season_key = '1997/1998' AND result IS NOT NULL THEN CAST(1400 + match_key * 37 % 200 AS DOUBLE) "
        "ELSE 1500.0 END) AS elo_home, CAST(1500.0 * count(*) AS DOUBLE) AS elo_away, season_key <> '1997/1998' AS kept "
        "FROM fact GROUP BY season_key"
    ),
    "upsert_moved_season": on_matches(f"""
, seasons AS (SELECT *, {SEASON} AS season_key FROM matches),
moved AS (
  SELECT * REPLACE (CASE WHEN moves THEN '1995/1996' ELSE season_key END AS season_key,
    CASE WHEN NOT moves THEN round_number END AS round_number)
  FROM (SELECT *, season_key = '1994/1995' AND match_id % 10 = 0 AS moves FROM seasons))
SELECT season_key, count(*) AS matches, CAST(sum(round_number) AS BIGINT) AS rounds,
  count(*) FILTER (WHERE moves) AS postponed, count(*) FILTER (WHERE moves OR season_key >= '1999/2000') AS told,
  season_key < '1999/2000' AND season_key NOT IN ('1994/1995', '1995/1996') AS kept
FROM moved GROUP BY season_key"""),
    "temp_view_sql": on_matches(
        "SELECT league, result, count(*) AS matches, min(match_date) AS first_day "
        "FROM matches WHERE result IS NOT NULL GROUP BY league, result"
    ),
    "run_audit": on_matches(
        f", {FACT.strip()} SELECT count(*) AS matches, count(DISTINCT league_key) AS leagues, "
        "count(DISTINCT concat(league_key, '|', season_key)) AS league_seasons, "
        "count(*) FILTER (WHERE result IS NULL) AS without_rating FROM fact"
    ),
    "scan_json_documents": on_matches(
        "SELECT CAST(round_number AS BIGINT) AS round_number, count(*) AS events "
        "FROM matches GROUP BY 1"
    ),
    "load_rejects": on_matches(
        "SELECT 'error' AS reason, count(DISTINCT round_number) AS rows FROM matches WHERE round_number % 17 = 3 "
        "UNION ALL SELECT 'corrupt', count(DISTINCT round_number) FROM matches WHERE round_number % 23 = 5 "
        "UNION ALL SELECT 'events of accepted', count(*) FROM matches"
    ),
    "unrated_events": on_matches(
        "SELECT round_number, event_number, match_id AS match_key FROM matches WHERE result IS NULL"
    ),
    "rolling_origin": _rolling(),
    "rolling_pairs": _rolling_pairs(),
    "simultaneous_limits": _simultaneous(),
    "pool_gradient": _flat(interaction=False),
    "pool_gradient_interaction": _flat(interaction=True),
    "pool_balance": on_matches(
        "SELECT result AS class, count(*) AS matches FROM matches WHERE result IS NOT NULL GROUP BY 1"
    ),
    "extract_events": on_matches(
        "SELECT CAST(round_number AS BIGINT) AS round_number, CAST(event_number AS BIGINT) AS event_number, "
        "* EXCLUDE (round_number, event_number, match_date) FROM matches"
    ),
    "filter_played": on_matches("SELECT match_id, result FROM matches WHERE result IS NOT NULL"),
    "scope_filter": on_matches(f"SELECT match_id, league FROM matches WHERE {SCOPED}"),
    "scope_semi": on_matches(f"SELECT match_id, league FROM matches WHERE {SCOPED}"),
    "scope_loosely": on_matches(
        "SELECT match_id, CASE match_id % 3 WHEN 0 THEN upper(league) WHEN 1 THEN replace(league, ' ', ',  ') ELSE league END AS league "
        f"FROM matches WHERE {SCOPED}"
    ),
    "time_split": on_matches(
        f"SELECT match_id, match_date, result, CASE WHEN match_date < DATE '{CUTOFF}' THEN 'train' "
        "ELSE 'test' END AS part FROM matches WHERE result IS NOT NULL"
    ),
    "result_label": on_matches("SELECT match_id, result FROM matches"),
    "long_outcomes": on_matches(
        " UNION ALL ".join(
            f"SELECT round_number, event_number, match_id, result, '{v}' AS outcome, crowd_{s} AS predicted_prob, "
            f"result = '{v}' AS actual_occurred FROM matches WHERE result IS NOT NULL"
            for s, v in (("1", "1"), ("x", "X"), ("2", "2"))
        )
    ),
    "season_key": on_matches("""
, y AS (SELECT match_id, CASE WHEN month(match_date) >= 7 THEN year(match_date) ELSE year(match_date) - 1 END AS y FROM matches)
SELECT match_id, concat(y, '/', y + 1) AS season_key, make_date(y, 7, 1) AS start_date,
  make_date(y + 1, 6, 30) AS end_date FROM y"""),
    "scalar_string": "SELECT c_custkey, upper(c_name) AS name_key, regexp_replace(c_name, '^Customer#', '') AS number_text, "
    "replace(CAST(CAST(c_acctbal AS DECIMAL(12, 2)) AS VARCHAR), '.', ',') AS balance_text, "
    "concat(lower(c_mktsegment), '/', CAST(c_nationkey AS VARCHAR)) AS segment_key FROM customer",
    "scalar_date": on_matches(
        "SELECT match_id, match_date AS day, CAST(strftime(match_date, '%Y%m%d') AS INT) AS date_key, "
        "CAST(quarter(match_date) AS INT) AS quarter, strftime(match_date, '%B') AS month_name, "
        "strftime(match_date, '%A') AS day_name, CAST(isodow(match_date) AS INT) AS day_of_week, "
        "CAST(week(match_date) AS INT) AS week_of_year FROM matches"
    ),
    "scalar_math": "SELECT l_orderkey, l_linenumber, "
    "round(ln(least(greatest(l_extendedprice, 1.0), 50000.0)), 5) AS log_price, "
    "round(pow(l_discount - 0.05, 2), 5) AS squared, round(abs(l_quantity - 25.0), 5) AS distance, "
    "round(sqrt(l_quantity), 5) AS root, round(ln(l_extendedprice / l_quantity), 5) AS log_unit_price FROM lineitem",
    "parse_decimal": on_matches(
        "SELECT match_id, odds_1, crowd_1, odds_x, CAST(NULL AS DOUBLE) AS malformed, "
        "CAST(betradar_id AS INT) AS betradar_number FROM matches"
    ),
    "array_pick": on_matches(
        "SELECT match_id, CASE WHEN league <> 'Cup' THEN betradar_id END AS betradar_id FROM matches"
    ),
    "latest_per_match": on_matches(
        "SELECT match_id, CASE WHEN league = 'Cup' THEN round_number + 1 ELSE round_number END AS round_number, "
        "event_number, league, CASE WHEN league = 'Cup' THEN 'Moved' ELSE status END AS status FROM matches"
    ),
    "dim_team": on_matches(f", {TEAMS.strip()} SELECT * FROM teams"),
    "dim_date": on_matches(f", {DATES.strip()} SELECT * FROM dates"),
    "dim_league": on_matches(
        "SELECT DISTINCT upper(league) AS league_key, league AS league_name, league_country AS country FROM matches"
    ),
    "dim_season": on_matches(f"""
, y AS (SELECT DISTINCT CASE WHEN month(match_date) >= 7 THEN year(match_date) ELSE year(match_date) - 1 END AS y
        FROM matches WHERE {SCOPED})
SELECT concat(y, '/', y + 1) AS season_key, make_date(y, 7, 1) AS start_date, make_date(y + 1, 6, 30) AS end_date,
  DATE '{AS_OF}' BETWEEN make_date(y, 7, 1) AND make_date(y + 1, 6, 30) AS is_current FROM y"""),
    "fact_match": on_matches(f", {FACT.strip()} SELECT * FROM fact"),
    "fact_league_season": on_matches(f"""
, {FACT.strip()}
SELECT league_key, season_key, count(*) AS match_count, CAST(sum(home_goals + away_goals) AS BIGINT) AS total_goals,
  round(avg(home_goals + away_goals), 3) AS avg_goals, count(*) FILTER (WHERE result = '1') AS home_wins,
  count(*) FILTER (WHERE result = 'X') AS draws, count(*) FILTER (WHERE result = '2') AS away_wins,
  round(CAST(count(*) FILTER (WHERE result = '1') AS DOUBLE) / count(*), 3) AS home_win_rate
FROM fact WHERE result IS NOT NULL GROUP BY league_key, season_key"""),
    "star_join": on_matches(f"""
, {FACT.strip()}, {TEAMS.strip()}, {DATES.strip()}, {LOOKUP.strip()}
SELECT h.country AS home_country, a.country AS away_country, league_name, year, is_weekend, count(*) AS matches,
  CAST(sum(home_goals) AS BIGINT) AS home_goals
FROM fact JOIN teams h ON h.team_key = home_team_key JOIN teams a ON a.team_key = away_team_key
JOIN lookup ON upper(league_name) = league_key JOIN dates ON dates.date_key = fact.date_key
GROUP BY 1, 2, 3, 4, 5"""),
    "left_lookup": on_matches(
        f", {LOOKUP.strip()} SELECT league, match_id, country FROM matches LEFT JOIN lookup ON league = league_name"
    ),
    "elo_ratings": on_matches(
        f", {ELO.strip()} SELECT match_id, round(elo_home, 4) AS elo_home, round(elo_away, 4) AS elo_away FROM elo",
        recursive=True,
    ),
    "elo_linked": on_matches(
        f", {LINKED.strip()}, {ELO_LINKED.strip()} SELECT match_id, round(elo_home, 4) AS elo_home, round(elo_away, 4) AS elo_away FROM elo",
        recursive=True,
    ),
    "elo_summary": on_matches(
        f", {ELO.strip()} SELECT count(*) AS matches, round(min(elo_home), 1) AS lowest, "
        "round(max(elo_home), 1) AS highest, round(avg(elo_home), 1) AS mean FROM elo",
        recursive=True,
    ),
    "elo_topk": on_matches(
        f", {ELO.strip()} SELECT e.match_id, home_team, round(elo_home, 1) AS elo FROM elo e "
        "JOIN matches m ON m.match_id = e.match_id ORDER BY elo_home DESC, e.match_id LIMIT 10",
        recursive=True,
    ),
    "elo_scored_join": on_matches(
        f", {CHEAP.strip()} SELECT match_id, home_team, elo_home, elo_away, round(e, 6) AS elo_expected_score FROM expected"
    ),
    "elo_expected": on_matches(
        f", {CHEAP.strip()} SELECT match_id, round(e, 6) AS elo_expected_score FROM expected"
    ),
    "elo_predictor": on_matches(
        f", {CHEAP.strip()} SELECT match_id, round(e, 6) AS signal_1, round(0.5 - abs(e - 0.5), 6) AS signal_x, "
        "round(1.0 - e, 6) AS signal_2 FROM expected"
    ),
    "elo_long": on_matches(
        f", {CHEAP.strip()} "
        + " UNION ALL ".join(
            f"SELECT '{v}' AS outcome, round({x}, 6) AS predicted_prob, result = '{v}' AS actual_occurred "
            "FROM expected WHERE result IS NOT NULL"
            for v, x in (("1", "e"), ("X", "0.5 - abs(e - 0.5)"), ("2", "1.0 - e"))
        )
    ),
    "elo_probs": on_matches(
        f", {ELO.strip()}, {RATING_CURVE.strip()} "
        "SELECT match_id, result, round(e, 6) AS elo_expected_score, round(p1 / (p1 + px + p2), 6) AS elo_1, "
        "round(px / (p1 + px + p2), 6) AS elo_x, round(p2 / (p1 + px + p2), 6) AS elo_2 "
        "FROM chances JOIN rated USING (match_id)",
        recursive=True,
    ),
    "isotonic_curve": on_matches(f"""
, {CURVE.strip()},
ends AS (SELECT *, lag(v) OVER w AS before, lead(v) OVER w AS after FROM curve
         WINDOW w AS (PARTITION BY outcome ORDER BY x))
SELECT outcome, x AS boundary, round(v, 6) AS value FROM ends
WHERE before IS NULL OR after IS NULL OR before <> v OR after <> v"""),
    "calibrated_probs": on_matches(
        f", {CURVE.strip()} SELECT match_id, round(calibrated_1, 6) AS calibrated_1, "
        "round(calibrated_x, 6) AS calibrated_x, round(calibrated_2, 6) AS calibrated_2 FROM calibrated"
    ),
    "calibration_metrics": on_matches(f", {CURVE.strip()} {_calibration_metrics()}"),
    "mart_score": on_matches(f"""
, {MART.strip()}
SELECT * REPLACE (round(calibrated_1, 6) AS calibrated_1, round(calibrated_x, 6) AS calibrated_x,
  round(calibrated_2, 6) AS calibrated_2, round(elo_home, 4) AS elo_home, round(elo_away, 4) AS elo_away,
  round(elo_expected_score, 6) AS elo_expected_score) FROM mart""", recursive=True),
    "mart_gap": on_matches(
        f", {MART.strip()} SELECT match_key, event_number, "
        "round(crowd_1 + crowd_x / 2 - elo_expected_score, 6) AS gap FROM mart",
        recursive=True,
    ),
    "mart_vs_results": on_matches(
        f"SELECT match_id AS match_key, result, round({_brier('crowd')}, 10) AS brier_crowd, "
        f"round({_brier('favourite_odds')}, 10) AS brier_favourite_odds FROM matches "
        f"WHERE result IS NOT NULL AND {SCOPED}"
    ),
    "split_describe": on_matches(f"""
, parts AS (
  SELECT CASE WHEN match_date < DATE '{CUTOFF}' THEN 'train' ELSE 'test' END AS part, count(*) AS matches,
    min(match_date) AS first_day, max(match_date) AS last_day
  FROM matches WHERE result IS NOT NULL GROUP BY 1)
SELECT *, round(matches / (SELECT sum(matches) FROM parts), 6) AS share FROM parts"""),
    "brier_row": on_matches(
        f"SELECT match_id, round({_brier('crowd')}, 6) AS brier FROM matches WHERE result IS NOT NULL"
    ),
    "pooled_brier": on_matches(
        f", {EVEN.strip()} "
        + " UNION ALL ".join(
            f"SELECT '{p}' AS forecast, round(avg({_brier(p)}), 8) AS brier FROM judged"
            for p in ("even", "crowd", "favourite_odds")
        )
    ),
    "paired_brier": on_matches(f"""
, {EVEN.strip()}, {_pairs().strip()}
SELECT baseline, candidate, round(mean_difference, 8) AS mean_difference, round(sd, 8) AS sd, n,
  round(standard_error, 8) AS standard_error, round(t_statistic, 4) AS t_statistic,
  round(ci_low, 8) AS ci_low, round(ci_high, 8) AS ci_high FROM paired"""),
    "paired_verdict": on_matches(
        f", {EVEN.strip()}, {_pairs().strip()} SELECT baseline, candidate, "
        "CASE WHEN ci_low > 0 THEN 'better' WHEN ci_high < 0 THEN 'worse' "
        "ELSE 'no measurable difference' END AS verdict FROM paired"
    ),
    "blend": on_matches(
        "SELECT match_id, "
        + ", ".join(
            f"round(0.3 * crowd_{s} + 0.7 * favourite_odds_{s}, 6) AS blended_{s}" for s in ("1", "x", "2")
        )
        + " FROM matches"
    ),
    "fit_blend_weight": on_matches(_blend_grid()),
    "logit_features": on_matches(_logit_features()),
}
