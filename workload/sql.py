"""DuckDB text of the same views, to be put in front of each check query."""

from __future__ import annotations

from tickerpulse.schemas import INSTRUMENTS

from . import views as v


def quoted(value) -> str:
    if value is None:
        return "NULL"
    return "'" + value.replace("'", "''") + "'" if isinstance(value, str) else repr(value)


def case(expr: str, choices: dict) -> str:
    arms = " ".join(f"WHEN {quoted(k)} THEN {quoted(x)}" for k, x in choices.items())
    return f"CASE {expr} {arms} END"


def values(rows) -> str:
    return ", ".join("(" + ", ".join(quoted(x) for x in row) + ")" for row in rows)


def stop_list() -> str:
    return ", ".join(quoted(w) for w in v.STOPWORDS)


CLEAN = r"""regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower({t}),
  '(https?\://)\S+', ' ', 'g'), '[^a-zA-Z0-9]', ' ', 'g'), '\b\d+\b', ' ', 'g'),
  '\b[a-zA-Z0-9]{{1,2}}\b', ' ', 'g'), '\s+', ' ', 'g')"""


def clean(column: str) -> str:
    return CLEAN.format(t=column)


POSTS = f"""posts AS (
  SELECT CAST(doc_id AS VARCHAR) AS t_key,
    text || ' #' || lang || ' #' || source || ' https://x.example/' || CAST(doc_id AS VARCHAR) AS text,
    788918400 + (doc_id % 2400) * 86400 + (doc_id * 7919) % 86400 AS created,
    {case("CAST(substr(source, 4) AS INTEGER) % 6", dict(enumerate(v.POST_TERMS)))} AS search_term,
    CAST(n_chars % 50 AS INTEGER) AS like_count, CAST(doc_id % 7 AS INTEGER) AS retweet_count,
    CAST(n_chars % 1000 AS INTEGER) AS followers_count,
    'u' || CAST(doc_id % 150 AS VARCHAR) AS writer, doc_id AS tweet_id
  FROM documents)"""

SCORED = f"""scored AS (
  SELECT CAST(event_id AS VARCHAR) AS t_key, CAST(floor(epoch(ts)) AS BIGINT) AS created,
    {case("event_type", v.EVENT_TERMS)} AS search_term, CAST(0 AS BIGINT) AS id,
    event_type || ' ' || props AS processed_text,
    CASE WHEN user_id % 37 = 1 THEN NULL WHEN user_id % 10 = 0 THEN 0.0::DOUBLE
         ELSE round(value - 25, 2) END AS polarity
  FROM events)"""

PRICES = f"""prices AS (
  SELECT {case("o_orderpriority", v.PRICE_SYMBOLS)} AS symbol, CAST(o_orderdate AS DATE) AS dt,
    min_by(o_totalprice, o_orderkey) AS open, max(o_totalprice) AS high, min(o_totalprice) AS low,
    max_by(o_totalprice, o_orderkey) AS close, CAST(count(*) AS BIGINT) AS volume
  FROM orders GROUP BY 1, 2)"""

VALUES = f"""cvalues AS (
  SELECT {case("symbol", v.SYMBOL_TICKERS)} AS ticker_symbol, dt AS day_date, open AS open_value,
    high AS high_value, low AS low_value, close AS close_value, volume FROM prices)"""

TICKERS = f"""tickers AS (
  SELECT user_id AS tweet_id, {case("event_type", {**v.EVENT_TERMS, "signup": "GOOGL"})} AS ticker_symbol,
    event_id AS line FROM events)"""

INSTRUMENTS_SQL = f"""instruments AS (
  SELECT * FROM (VALUES {values(INSTRUMENTS)}) AS t(symbol, ticker, term, company))"""

COMPANIES = """companies AS (
  SELECT ticker AS ticker_symbol, company AS company_name FROM instruments WHERE company IS NOT NULL)"""

_LEX = "lex AS (SELECT w, CAST(v AS DOUBLE) AS v FROM (VALUES {}) AS t(w, v))".format(
    values(v.LEXICON.words.items()))
_BOOST = "boost AS (SELECT w, CAST(b AS DOUBLE) AS b FROM (VALUES {}) AS t(w, b))".format(
    values(v.LEXICON.boosters.items()))
_NEG = "neg AS (SELECT w FROM (VALUES {}) AS t(w))".format(values([(w,) for w in v.LEXICON.negators]))


def _step(n: int, damping: float, caps: bool) -> str:
    """One modifier word, n places back, applied to the value so far."""
    prev = "a0" if n == 1 else f"a{n - 1}"
    boost = f"coalesce(b{n}, 0) * CASE WHEN {prev} < 0 THEN -1 ELSE 1 END"
    if caps:
        boost += (f" + CASE WHEN c{n} AND b{n} IS NOT NULL THEN CASE WHEN {prev} > 0 THEN caps ELSE -caps END"
                  " ELSE 0 END")
    return (f"st{n} AS (SELECT *, CASE WHEN v{n} IS NOT NULL THEN {prev} ELSE ({prev} + ({boost}) * "
            f"CAST({damping} AS DOUBLE)) * CASE WHEN n{n} THEN CAST(-0.74 AS DOUBLE) ELSE 1 END END AS a{n} "
            f"FROM {'st0' if n == 1 else f'st{n - 1}'})")


def _chain(caps: bool) -> str:
    lags = ", ".join(
        f"lag(v, {d}) OVER o AS v{d}, lag(b, {d}) OVER o AS b{d}, lag(n, {d}) OVER o AS n{d}"
        + (f", lag(c, {d}) OVER o AS c{d}" if caps else "") for d in (1, 2, 3))
    shouted = "CASE WHEN c THEN v + CASE WHEN v > 0 THEN caps ELSE -caps END ELSE v END" if caps else "v"
    parts = [
        f"""lagged AS (SELECT *, {lags},
          min(CASE WHEN low = 'but' THEN pos END) OVER (PARTITION BY t_key) AS but_at
          FROM coded WINDOW o AS (PARTITION BY t_key ORDER BY pos))""",
        f"st0 AS (SELECT *, {shouted} AS a0 FROM lagged WHERE v IS NOT NULL)",
        _step(1, 1.0, caps), _step(2, 0.95, caps), _step(3, 0.9, caps),
        """totals AS (SELECT t_key, sum(a3 * CASE WHEN but_at IS NULL OR pos = but_at THEN 1.0::DOUBLE
          WHEN pos < but_at THEN 0.5 ELSE 1.5 END ORDER BY pos) AS s FROM st3 GROUP BY t_key)""",
    ]
    return ",\n".join(parts)


_CODES = """LEFT JOIN lex ON lex.w = k.low LEFT JOIN boost ON boost.w = k.low LEFT JOIN neg ON neg.w = k.low"""

# compound(t_key, compound) of the cleaned text
COMPOUND_CLEAN = f"""{_LEX}, {_BOOST}, {_NEG},
cleaned AS (SELECT *, {clean("text")} AS processed_text FROM posts),
words AS (SELECT t_key, list_filter(string_split(processed_text, ' '), lambda x: x <> '') AS ws FROM cleaned),
toks AS (SELECT t_key, unnest(ws) AS low, generate_subscripts(ws, 1) AS pos FROM words),
coded AS (SELECT k.*, lex.v, boost.b, neg.w IS NOT NULL AS n FROM toks k {_CODES}),
{_chain(False)},
compound AS (SELECT p.t_key, round(coalesce(s, 0) / sqrt(coalesce(s, 0) * coalesce(s, 0) + 15), 4) + 0.0 AS compound
  FROM posts p LEFT JOIN totals USING (t_key))"""

# compound(t_key, compound) of the text as written
COMPOUND_RAW = rf"""{_LEX}, {_BOOST}, {_NEG},
words AS (SELECT t_key, list_filter(string_split_regex(text, '\s+'), lambda x: x <> '') AS ws FROM posts),
toks0 AS (SELECT t_key, unnest(ws) AS w0, generate_subscripts(ws, 1) AS pos FROM words),
toks1 AS (SELECT t_key, pos, CASE WHEN length(regexp_replace(w0, '^[[:punct:]]+|[[:punct:]]+$', '', 'g')) <= 2
  THEN w0 ELSE regexp_replace(w0, '^[[:punct:]]+|[[:punct:]]+$', '', 'g') END AS word FROM toks0),
toks2 AS (SELECT *, lower(word) AS low, word = upper(word) AND word <> lower(word) AS c FROM toks1),
toks AS (SELECT *, CASE WHEN count(*) FILTER (WHERE c) OVER p > 0 AND count(*) FILTER (WHERE c) OVER p < count(*) OVER p
  THEN CAST(0.733 AS DOUBLE) ELSE 0 END AS caps FROM toks2 WINDOW p AS (PARTITION BY t_key)),
coded AS (SELECT k.*, lex.v, boost.b, neg.w IS NOT NULL OR contains(k.low, 'n''t') AS n FROM toks k {_CODES}),
{_chain(True)},
marks AS (SELECT t_key, least(length(text) - length(replace(text, '!', '')), 4) * CAST(0.292 AS DOUBLE)
  + CASE WHEN length(text) - length(replace(text, '?', '')) > 3 THEN CAST(0.96 AS DOUBLE)
    WHEN length(text) - length(replace(text, '?', '')) > 1
      THEN (length(text) - length(replace(text, '?', ''))) * CAST(0.18 AS DOUBLE) ELSE 0 END AS mark FROM posts),
summed AS (SELECT m.t_key, CASE WHEN coalesce(s, 0) > 0 THEN s + mark WHEN coalesce(s, 0) < 0 THEN s - mark
  ELSE 0 END AS s FROM marks m LEFT JOIN totals USING (t_key)),
compound AS (SELECT t_key, round(s / sqrt(s * s + 15), 4) + 0.0 AS compound FROM summed)"""

LABEL = """CASE WHEN compound > 0.05 THEN 'positive' WHEN compound < -0.05 THEN 'negative' ELSE 'neutral' END"""

WEIGHTED = """compound * (followers_count + 1) * (like_count + 1) * (retweet_count + 1)"""

# labelled posts with company names: the exploratory input
EDA = f"""last_company AS (
  SELECT tweet_id, arg_max_null(company_name, line) AS company_name
  FROM (SELECT t.tweet_id, t.line, c.company_name FROM tickers t LEFT JOIN companies c USING (ticker_symbol))
  GROUP BY tweet_id),
eda AS (SELECT p.*, strftime(make_timestamp(p.created * 1000000), '%Y-%m-%d') AS day_date,
  CAST(make_timestamp(p.created * 1000000) AS DATE) AS day, k.company_name, compound, {LABEL} AS sentiment
  FROM posts p JOIN compound USING (t_key) LEFT JOIN last_company k USING (tweet_id))"""


def day_of(column: str) -> str:
    return f"CAST(make_timestamp(CAST({column} AS BIGINT) * 1000000) AS DATE)"


def daily(source: str, polarity: str = "polarity", date: str | None = None) -> str:
    return f"""SELECT {date or day_of('created')} AS date, search_term, CAST(count(t_key) AS BIGINT) AS count,
      sum({polarity}) AS agg_polarity,
      CAST(count(*) FILTER (WHERE {polarity} > 0) AS BIGINT) AS positive_count,
      CAST(count(*) FILTER (WHERE {polarity} < 0) AS BIGINT) AS negative_count,
      CAST(count(*) FILTER (WHERE {polarity} = 0) AS BIGINT) AS neutral_count
    FROM {source} GROUP BY 1, 2"""


def with_ctes(*ctes: str, select: str, recursive: bool = False) -> str:
    if not ctes:
        return select
    return f"WITH {'RECURSIVE ' if recursive else ''}" + ",\n".join(ctes) + "\n" + select
