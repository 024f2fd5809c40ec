"""The registered queries as ANSI SQL over the same tables, written independently of the plans.

Long texts are put together from shared common table expressions.
"""

from __future__ import annotations

from pricebasket import constants

ORDER = "l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice"


def _case(column: str, values: dict[str, str]) -> str:
    whens = " ".join(f"WHEN '{key}' THEN '{value}'" for key, value in values.items())
    return f"CASE {column} {whens} END"


def _padded(column: str) -> str:
    text = f"CAST({column} AS VARCHAR)"
    return f"CASE WHEN length({text}) < 3 THEN lpad({text}, 3, '0') ELSE {text} END"


def _lat(key: str) -> str:
    return f"(29500 + ({key} * 37) % 3500) / CAST(1000 AS DOUBLE)"


def _lon(key: str) -> str:
    return f"(34300 + ({key} * 91) % 1500) / CAST(1000 AS DOUBLE)"


STORE_DIM = f"""
store_dim AS (
  SELECT s_suppkey, s_nationkey, s_name, n_name, n_regionkey % 3 AS chain_rank,
         CASE n_regionkey % 3 WHEN 0 THEN 'victory' WHEN 1 THEN 'shufersal' WHEN 2 THEN 'ramilevi' END AS chain,
         {_padded('s_suppkey')} AS store_id
  FROM supplier JOIN nation ON s_nationkey = n_nationkey)"""

OBS = f"""{STORE_DIM},
obs AS (
  SELECT chain, chain_rank, store_id, CAST(p_partkey % 97 AS VARCHAR) AS item_code,
         p_name || ' ' || p_brand AS item_name, CAST(l_extendedprice AS DECIMAL(12,2)) AS price,
         CAST(l_shipdate AS DATE) AS pulling_date,
         CAST(date_trunc('month', l_shipdate) AS DATE) AS month, {ORDER}
  FROM lineitem JOIN store_dim ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey)"""


def _catalog(snapshot: str) -> str:
    """CTEs up to ``priced`` (consolidated) and ``cat`` (merged), one catalogue per ``snapshot``."""
    return f"""{OBS},
ranked AS (
  SELECT *, {snapshot} AS snapshot,
    row_number() OVER (PARTITION BY {snapshot}, item_name, chain, store_id
      ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) AS from_last,
    row_number() OVER (PARTITION BY {snapshot}, item_name ORDER BY chain_rank, {ORDER}) AS from_first
  FROM obs),
lastp AS (SELECT snapshot, item_name AS name, chain, store_id, price FROM ranked WHERE from_last = 1),
born AS (
  SELECT snapshot, item_name AS name, item_code AS id, row_number() OVER (ORDER BY chain_rank, {ORDER}) AS born
  FROM ranked WHERE from_first = 1),
counts AS (
  SELECT snapshot, name, CAST(count(DISTINCT chain) AS INTEGER) AS chains_count, CAST(count(*) AS INTEGER) AS stores_count
  FROM lastp GROUP BY snapshot, name),
priced AS (
  SELECT snapshot, id, name, chain, store_id, price, chains_count, stores_count, born
  FROM lastp JOIN born USING (snapshot, name) JOIN counts USING (snapshot, name)),
singles AS (SELECT * FROM priced WHERE chains_count = 1),
winner AS (SELECT snapshot, id, chain, max(born) AS born FROM singles GROUP BY snapshot, id, chain),
merged_name AS (SELECT snapshot, id, min(name) AS merged FROM singles GROUP BY snapshot, id),
merged AS (
  SELECT s.snapshot, s.id, n.merged AS name, s.chain, s.store_id, s.price
  FROM singles s JOIN winner USING (snapshot, id, chain, born) JOIN merged_name n USING (snapshot, id)),
merged_counts AS (
  SELECT snapshot, id, CAST(count(DISTINCT chain) AS INTEGER) AS chains_count, CAST(count(*) AS INTEGER) AS stores_count
  FROM merged GROUP BY snapshot, id),
cat AS (
  SELECT snapshot, id, name, chain, store_id, price, chains_count, stores_count FROM priced WHERE chains_count > 1
  UNION ALL
  SELECT m.snapshot, m.id, m.name, m.chain, m.store_id, m.price, c.chains_count, c.stores_count
  FROM merged m JOIN merged_counts c USING (snapshot, id))"""


MONTHLY = _catalog("month")
ALL_DATES = _catalog("DATE '1900-01-01'")
LONG = "id, name, chain, store_id, price, chains_count, stores_count"


def _totals(lines: str) -> str:
    """CTEs from ``lines`` (cart_id, name, quantity), a query, to ``totals`` per covering store."""
    return f"""
cart_lines AS ({lines}),
wanted AS (SELECT cart_id, count(DISTINCT name) AS products FROM cart_lines GROUP BY cart_id),
offered AS (
  SELECT cart_id, chain, store_id, count(DISTINCT name) AS products,
         CAST(sum(price * quantity) AS DECIMAL(38,2)) AS total
  FROM cart_lines JOIN cat USING (name)
  WHERE CAST(price * 100 AS BIGINT) % 10 <> 3 GROUP BY cart_id, chain, store_id),
totals AS (
  SELECT o.cart_id, o.chain, o.store_id, o.total FROM offered o
  JOIN wanted w ON o.cart_id = w.cart_id AND o.products = w.products)"""


def _nearest(users: str) -> str:
    """CTEs from ``totals`` and ``users`` (cart_id, user_lat, user_lon), a query, to ``nearest``."""
    return f"""
users AS ({users}),
placed AS (
  SELECT t.cart_id, t.chain, t.store_id, d.s_name AS store_name, t.total, u.user_lat, u.user_lon,
         {_lat('d.s_suppkey')} AS latitude, {_lon('d.s_suppkey')} AS longitude
  FROM totals t JOIN store_dim d USING (chain, store_id) JOIN users u USING (cart_id) WHERE d.s_suppkey % 6 <> 5),
measured AS (
  SELECT cart_id, chain, store_id, store_name, total,
    round(2 * CAST(6371008.8 AS DOUBLE) * asin(sqrt(least(1.0,
      pow(sin(radians(latitude - user_lat) / 2), 2)
      + cos(radians(user_lat)) * cos(radians(latitude)) * pow(sin(radians(longitude - user_lon) / 2), 2)))), 2) AS distance
  FROM placed),
near AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY cart_id ORDER BY distance, chain, store_id) AS INTEGER) AS rank FROM measured),
nearest AS (SELECT * FROM near WHERE rank <= {constants.NEAREST_STORES}),
lowest AS (SELECT cart_id, min(total) AS min_price_all FROM totals GROUP BY cart_id),
chosen AS (SELECT *, row_number() OVER (PARTITION BY cart_id ORDER BY total, rank) AS pick FROM nearest),
best AS (
  SELECT cart_id, chain, store_id, store_name, total AS store_price, distance, min_price_all
  FROM lowest LEFT JOIN (SELECT * FROM chosen WHERE pick = 1) USING (cart_id))"""


ORDER_LINES = """SELECT l_orderkey AS cart_id, p_name || ' ' || p_brand AS name,
  CAST(l_quantity AS DECIMAL(14,6)) AS quantity FROM lineitem JOIN part ON l_partkey = p_partkey"""
ORDER_USERS = f"SELECT o_orderkey AS cart_id, {_lat('o_custkey')} AS user_lat, {_lon('o_custkey')} AS user_lon FROM orders"
PART_USERS = f"SELECT p_partkey AS cart_id, {_lat('p_partkey')} AS user_lat, {_lon('p_partkey')} AS user_lon FROM part"

MESSAGES = """
messages AS (
  SELECT p_partkey AS cart_id, CASE p_type
    WHEN 'STANDARD' THEN whole || ', ' || p_name || ' 2'
    WHEN 'PROMO' THEN '  ' || upper(p_name) || '   1.5,' || whole
    WHEN 'LARGE' THEN whole || ',small ring ' || p_brand || ' 2,red widget ' || p_brand || ' 2,blue bolt ' || p_brand
      || ' 2,old gear ' || p_brand || ' 2,new plate ' || p_brand || ' 2,' || whole
    WHEN 'SMALL' THEN whole || ','
    WHEN 'ECONOMY' THEN whole || ', ' || p_brand || ' ' || (['x', '999999999', '0.0000004', '0.0004', '1.2345'])[1 + p_partkey % 5]
    ELSE whole || ', unheard pack 1' END AS message
  FROM (SELECT *, p_name || ' ' || p_brand || ' ' || p_size AS whole FROM part))"""


def _parsed(messages: str) -> str:
    """CTE ``parsed``: the cart lines of ``messages``, a table name or a query in brackets."""
    return f"""
pieces AS (
  SELECT cart_id, CAST(unnest(range(len(parts))) AS INTEGER) AS pos, unnest(parts) AS piece
  FROM (SELECT cart_id, string_split(message, ',') AS parts FROM {messages})),
worded AS (
  SELECT cart_id, pos, list_filter(regexp_split_to_array(piece, '\\s+'), lambda w: w <> '') AS words FROM pieces),
parsed AS (
  SELECT cart_id, pos,
    CASE WHEN len(words) > 1 THEN array_to_string(words[1:len(words) - 1], ' ') ELSE '' END AS product_name,
    CASE WHEN len(words) > 0 THEN words[len(words)] ELSE '' END AS quantity_text,
    CASE WHEN amount = TRY_CAST(amount AS DECIMAL(14,6)) THEN TRY_CAST(amount AS DECIMAL(14,6)) END AS quantity,
    len(words) > 1 AND coalesce(amount = TRY_CAST(amount AS DECIMAL(14,6)), false) AS valid
  FROM (SELECT *, CASE WHEN len(words) > 0 THEN TRY_CAST(words[len(words)] AS DECIMAL(38,18)) END AS amount FROM worded))"""


def _tokens(column: str) -> str:
    return (
        f"list_filter(string_split(lower(regexp_replace({column}, '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')), ' '), lambda w: w <> '')"
    )


def _search(requests: str) -> str:
    """CTEs from ``requests`` (request), a query, to ``found`` (request, name, score): every pair scored."""
    k1, b = f"CAST({constants.BM25_K1} AS DOUBLE)", f"CAST({constants.BM25_B} AS DOUBLE)"
    norm = f"({k1} + 1) / (tf + {k1} * (1 - {b} + {b} * length / mean_length)) * tf"
    return f"""
listed AS (
  SELECT name, max(chains_count) * CAST({constants.CHAINS_WEIGHT} AS DOUBLE)
    + max(stores_count) * CAST({constants.STORES_WEIGHT} AS DOUBLE) AS popularity FROM cat GROUP BY name),
named AS (SELECT name, popularity, {_tokens('name')} AS tokens FROM listed),
indexed AS (SELECT name, popularity, tokens, CAST(len(tokens) AS DOUBLE) AS length FROM named WHERE len(tokens) > 0),
totals_of AS (SELECT count(*) AS n, avg(length) AS mean_length FROM indexed),
uses AS (
  SELECT name, popularity, length, term, CAST(count(*) AS DOUBLE) AS tf
  FROM (SELECT name, popularity, length, unnest(tokens) AS term FROM indexed) GROUP BY name, popularity, length, term),
idfs AS (
  SELECT term, ln(1 + (n - d + CAST(0.5 AS DOUBLE)) / (d + CAST(0.5 AS DOUBLE))) AS idf
  FROM (SELECT term, count(*) AS d FROM uses GROUP BY term), totals_of),
asked AS (SELECT DISTINCT request, {_tokens('request')} AS tokens FROM ({requests}) WHERE request IS NOT NULL),
asked_terms AS (
  SELECT request, term, count(*) AS times FROM (SELECT request, unnest(tokens) AS term FROM asked) GROUP BY request, term),
matched AS (
  SELECT request, name, sum(idf * times * {norm} * popularity) AS score
  FROM asked_terms JOIN uses USING (term) JOIN idfs USING (term), totals_of GROUP BY request, name),
lifted AS (
  SELECT request, name, idf * {norm.replace('tf', 'CAST(1 AS DOUBLE)')} * popularity AS lift
  FROM asked JOIN indexed i ON i.tokens[1] = request JOIN idfs ON idfs.term = request, totals_of
  WHERE len(asked.tokens) = 1 AND asked.tokens[1] = request),
scored AS (SELECT request, name, round(score + coalesce(lift, 0), 6) AS score FROM matched LEFT JOIN lifted USING (request, name)),
found AS (
  SELECT request, name, score FROM (
    SELECT *, row_number() OVER (PARTITION BY request ORDER BY score DESC, name) AS place FROM scored) WHERE place = 1)"""


# From messages to the status of every cart and the answers of those that can be answered.
ANSWERS = f"""WITH {ALL_DATES}, {MESSAGES}, {_parsed('messages')},
{_search('SELECT product_name AS request FROM parsed WHERE valid')},
items AS (
  SELECT p.*, f.name FROM parsed p LEFT JOIN found f ON p.valid AND p.product_name = f.request),
whole_carts AS (SELECT cart_id FROM items GROUP BY cart_id HAVING bool_and(valid AND name IS NOT NULL)),
{_totals('SELECT cart_id, name, quantity FROM items JOIN whole_carts USING (cart_id)')},
{_nearest(PART_USERS)},
statuses AS (
  SELECT cart_id, count(*) AS items, count(*) FILTER (NOT valid) AS bad_items,
    count(*) FILTER (valid AND name IS NULL) AS unknown_items,
    CASE WHEN count(*) FILTER (NOT valid) > 0 THEN 'bad_input'
         WHEN count(*) FILTER (valid AND name IS NULL) > 0 THEN 'not_found'
         WHEN cart_id NOT IN (SELECT cart_id FROM totals) THEN 'no_store' ELSE 'ok' END AS status
  FROM items GROUP BY cart_id)"""

STORES = f"""SELECT store_id, chain, {_case('chain', constants.CHAIN_IDS)} AS chain_id,
  {_case('chain', constants.CHAIN_NAMES)} AS chain_name, s_name AS store_name, store_id AS address, n_name AS city
  FROM store_dim"""

DAILY = f"""{OBS},
daily AS (
  SELECT pulling_date, item_name AS name, chain, store_id, price FROM (
    SELECT *, row_number() OVER (PARTITION BY pulling_date, item_name, chain, store_id
      ORDER BY l_orderkey DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) AS from_last
    FROM obs) WHERE from_last = 1)"""

LINE = "PARTITION BY name, chain, store_id ORDER BY"


def _intervals(starts: str) -> str:
    """CTE ``folded``: runs of days of which none ``starts`` a new one but the first."""
    return f"""
marked AS (
  SELECT *, CASE WHEN lag(pulling_date) OVER line IS NULL OR {starts} THEN 1 ELSE 0 END AS starts
  FROM daily WINDOW line AS ({LINE} pulling_date)),
numbered AS (SELECT *, sum(starts) OVER ({LINE} pulling_date) AS island FROM marked),
folded AS (
  SELECT name, chain, store_id, min(price) AS price, min(pulling_date) AS valid_from, max(pulling_date) AS last_seen,
    count(*) AS days FROM numbered GROUP BY name, chain, store_id, island)"""


INTERVALS = f"""WITH {DAILY}, {_intervals('lag(price) OVER line <> price')}
  SELECT *, lead(valid_from) OVER ({LINE} valid_from) AS valid_to FROM folded"""

SENTIMENT = f"""
lexicon(word, polarity) AS (VALUES {', '.join(f"('{word}', CAST({value} AS DOUBLE))" for word, value in constants.LEXICON.items())}),
opinion AS (
  SELECT doc_id, round(avg(polarity), 6) AS sentiment
  FROM (SELECT doc_id, unnest({_tokens('text')}) AS word FROM documents) JOIN lexicon USING (word) GROUP BY doc_id),
sentiments AS (
  SELECT d.doc_id, coalesce(sentiment, CAST(0 AS DOUBLE)) AS sentiment FROM documents d LEFT JOIN opinion USING (doc_id))"""

_MODIFIERS = ", ".join(
    [f"('{word}', 'negation', CAST(0 AS DOUBLE))" for word in constants.NEGATIONS]
    + [f"('{word}', 'intensifier', CAST({value} AS DOUBLE))" for word, value in constants.INTENSIFIERS.items()])

SCORES = f"""WITH modifiers(word, kind, value) AS (VALUES {_MODIFIERS}),
tokens AS (
  SELECT doc_id, unnest(range(len(words))) AS pos, unnest(words) AS word FROM (SELECT doc_id, {_tokens('text')} AS words FROM documents)),
judged AS (SELECT d.doc_id, quality FROM documents d JOIN labels USING (doc_id) WHERE quality IN (0, 1) AND text IS NOT NULL),
sizes AS (SELECT CAST(count(*) FILTER (quality = 1) AS DOUBLE) AS goods, CAST(count(*) FILTER (quality = 0) AS DOUBLE) AS bads FROM judged),
counts AS (
  SELECT word, count(*) FILTER (quality = 1) AS good, count(*) FILTER (quality = 0) AS bad
  FROM (SELECT DISTINCT doc_id, word FROM tokens) JOIN judged USING (doc_id) GROUP BY word HAVING count(*) >= 5),
lexicon AS (
  SELECT word, 'opinion' AS kind, round((good * bads - bad * goods) / (good * bads + bad * goods), 6) AS value
  FROM counts, sizes WHERE goods > 0 AND bads > 0 AND word NOT IN (SELECT word FROM modifiers)
  UNION ALL SELECT * FROM modifiers),
known AS (
  SELECT doc_id, pos, kind, value,
    max(CASE WHEN kind = 'negation' THEN 1 END) OVER (PARTITION BY doc_id ORDER BY pos RANGE BETWEEN {constants.NEGATION_REACH} PRECEDING AND 1 PRECEDING) AS negated,
    max(CASE WHEN kind = 'intensifier' THEN value END) OVER (PARTITION BY doc_id ORDER BY pos RANGE BETWEEN 1 PRECEDING AND 1 PRECEDING) AS factor
  FROM tokens JOIN lexicon USING (word)),
scored AS (
  SELECT doc_id, greatest(least(value * coalesce(factor, 1) * CASE WHEN negated = 1 THEN CAST({constants.NEGATED} AS DOUBLE) ELSE 1 END, 1), -1) AS score
  FROM known WHERE kind = 'opinion'),
means AS (SELECT doc_id, count(*) AS opinions, round(avg(score), 6) AS sentiment FROM scored GROUP BY doc_id)
SELECT d.doc_id, coalesce(opinions, 0) AS opinions, CASE WHEN text IS NOT NULL THEN coalesce(sentiment, CAST(0 AS DOUBLE)) END AS sentiment
FROM documents d LEFT JOIN means USING (doc_id)"""

GEOCODED = f"""
addressed AS (
  SELECT c_custkey, lower(c_mktsegment || ' ' || (1 + c_custkey % 2) || ', ' || n_name) AS full_address, n_nationkey,
    c_custkey % 2 = n_nationkey % 2 AS known
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""

ALLOWED = ", ".join(f"('{chain}', '{store}')" for chain, ids in constants.STORE_ALLOWLIST.items() for store in ids)

REQUEST_LINES = """lines AS (
  SELECT p_name || ' ' || p_brand AS name FROM lineitem JOIN part ON l_partkey = p_partkey
  UNION ALL SELECT p_name FROM lineitem JOIN part ON l_partkey = p_partkey)"""


EVENT_CHAT = f"""
  SELECT 'e' || user_id AS chat_id, event_id AS "at", CASE event_id % 7 WHEN 0 THEN '{constants.START_WORDS[0]}'
      WHEN 1 THEN '{constants.START_WORDS[2]}' WHEN 2 THEN 'Top5' WHEN 5 THEN event_type || ' street' WHEN 6 THEN NULL
      ELSE 'milk ' || CAST(floor(value) AS BIGINT) || ', ' || event_type || ' 2' END AS text FROM events"""


def _chat(messages: str) -> str:
    """Each message of ``messages`` (chat_id, at, text), a query, one step after the other."""
    return f"""WITH RECURSIVE said AS (
  SELECT *, chat_id || '-' || i AS cart_id FROM (
    SELECT *, row_number() OVER (PARTITION BY chat_id ORDER BY "at") AS i FROM ({messages}))),
whole AS (SELECT cart_id, text AS message FROM said WHERE text IS NOT NULL), {_parsed('whole')},
lists AS (SELECT cart_id, bool_and(valid) AS sound FROM parsed GROUP BY cart_id),
kinds AS (
  SELECT s.*, CASE WHEN text = '{constants.START_WORDS[2]}' THEN 'again' WHEN text IN {constants.START_WORDS} THEN 'start'
    WHEN lower(text) = 'top5' THEN 'top_products' WHEN sound THEN 'list' ELSE 'other' END AS kind
  FROM said s LEFT JOIN lists USING (cart_id)),
moves AS (
  SELECT states.state, kinds.kind,
    CASE WHEN state = 'idle' AND kind IN ('again', 'start') THEN 'welcome' WHEN state IN ('idle', 'again') THEN 'ignored'
      WHEN state = 'choose' AND kind = 'top_products' THEN 'top_products' WHEN state = 'choose' THEN 'ask_place'
      WHEN state = 'place' THEN 'ask_list' WHEN kind = 'again' THEN 'ask_again' WHEN kind = 'list' THEN 'answer' ELSE 'bad_input' END AS step
  FROM (VALUES ('idle'), ('choose'), ('place'), ('list'), ('again')) AS states(state),
    (VALUES ('again'), ('start'), ('top_products'), ('list'), ('other')) AS kinds(kind)),
walk AS (
  SELECT chat_id, CAST(0 AS BIGINT) AS i, NULL::BIGINT AS "at", '' AS kind, '' AS state, '' AS step, 'idle' AS next_state, NULL::VARCHAR AS place
  FROM (SELECT DISTINCT chat_id FROM said)
  UNION ALL
  SELECT k.chat_id, k.i, k."at", k.kind, w.next_state, m.step,
    CASE m.step WHEN 'welcome' THEN 'choose' WHEN 'ask_place' THEN 'place' WHEN 'ask_list' THEN 'list' WHEN 'answer' THEN 'list'
      WHEN 'ask_again' THEN 'again' ELSE 'idle' END,
    CASE WHEN m.step = 'ask_list' THEN coalesce(k.text, '') ELSE w.place END
  FROM walk w JOIN kinds k ON k.chat_id = w.chat_id AND k.i = w.i + 1 JOIN moves m ON m.state = w.next_state AND m.kind = k.kind)
SELECT chat_id, "at", kind, state, step, next_state, place FROM walk WHERE i > 0"""


def _flat_post(extra: str = "") -> str:
    return f"""SELECT 'user ' || (doc_id % 1000) AS name, source AS location, 'https://example.org/' || doc_id AS url,
  false AS protected, true AS verified, CAST(n_chars % 1000 AS INTEGER) AS followers_count,
  CAST(n_chars % 100 AS INTEGER) AS friends_count, CAST(n_chars % 10 AS INTEGER) AS listed_count,
  1 AS favourites_count, 2 AS statuses_count, '2020-01-01T00:00:00' AS user_acount_created_at,
  CAST(doc_id % 1000 AS VARCHAR) AS user_id, text, '2024-01-01T00:00:00' AS tweet_created_at,
  CAST(doc_id AS VARCHAR) AS tweet_id FROM documents{extra}"""


ORACLES: dict[str, str] = {
    "xml_price_scan": f"""WITH {OBS} SELECT chain, chain_rank, {_case('chain', constants.CHAIN_IDS)} AS chain_id, store_id,
        item_code, item_name, price, pulling_date AS price_update_date, DATE '2023-01-01' AS pulling_date FROM obs""",
    "xml_store_scan": f"WITH {STORE_DIM} {STORES}",
    "html_links": """SELECT page_id, CAST(pos AS INTEGER) AS pos, href, contains(href, 'the') AS wanted FROM (
        SELECT page_id, unnest(range(len(pieces) - 1)) AS pos,
          unnest(list_transform(pieces[2:], lambda piece: replace(split_part(piece, '"', 1), '&amp;', '&'))) AS href
        FROM (SELECT page_id, string_split(html, '<a href="') AS pieces FROM pages))""",
    "daily_json_scan": f"WITH {MONTHLY} SELECT snapshot AS pulling_date, {LONG} FROM cat",
    "scan_head": "SELECT event_id, user_id, event_type FROM events ORDER BY ts, event_id LIMIT 10",
    "snapshot_roundtrip": f"WITH {MONTHLY} SELECT snapshot AS pulling_date, {LONG} FROM cat",
    "current_catalog": f"WITH {ALL_DATES} SELECT {LONG} FROM cat",
    "catalog_increment": f"WITH {ALL_DATES} SELECT {LONG} FROM cat",
    "to_json_messages": f"""WITH {ALL_DATES},
        per_chain AS (SELECT id, name, chains_count, stores_count, chain,
          string_agg('"' || store_id || '":"' || price || '"', ',' ORDER BY store_id) AS stores
          FROM cat GROUP BY id, name, chains_count, stores_count, chain)
        SELECT '{{"id":"' || id || '","name":"' || name || '","chains":{{'
          || string_agg('"' || chain || '":{{' || stores || '}}', ',' ORDER BY chain)
          || '}},"chains_count":' || chains_count || ',"stores_count":' || stores_count || '}}' AS value
        FROM per_chain GROUP BY id, name, chains_count, stores_count""",
    "canonical_obs": f"""WITH {OBS} SELECT chain, {_case('chain', constants.CHAIN_IDS)} AS chain_id, store_id, item_code,
        item_name, price, pulling_date, month AS snapshot FROM obs""",
    "stores_union": f"WITH {STORE_DIM} {STORES}",
    "store_allowlist": f"""WITH {OBS}, allowed(chain, store_id) AS (VALUES {ALLOWED})
        SELECT chain, store_id, item_code, item_name, price, pulling_date FROM obs
        WHERE (chain, store_id) IN (SELECT (chain, store_id) FROM allowed)""",
    "parse_json_props": "SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events",
    "post_flatten": _flat_post(),
    "post_filter": """SELECT doc_id, lang, text FROM documents
        WHERE lang = 'en' AND regexp_matches(text, '(?i)\\b(best|worthless)\\b')""",
    "cart_parse": f"""WITH {MESSAGES},
        everything AS (SELECT 'p' || cart_id AS cart_id, message FROM messages
          UNION ALL SELECT 'c-' || conv_id || '-' || turn, text FROM conversations), {_parsed('everything')}
        SELECT cart_id, pos, product_name, quantity_text, quantity, valid FROM parsed""",
    "cart_status": f"{ANSWERS} SELECT cart_id, items, bad_items, unknown_items, status FROM statuses",
    "cart_summary": f"""{ANSWERS} SELECT cart_id, '{constants.SUMMARY_HEADING}' || chr(10)
        || string_agg(name || ' ' || quantity_text, chr(10) ORDER BY pos) AS summary
        FROM items WHERE cart_id IN (SELECT cart_id FROM statuses WHERE status = 'ok') GROUP BY cart_id""",
    "message_intent": f"""WITH everything AS (
          SELECT conv_id, turn, role AS kind, text FROM conversations
          UNION ALL SELECT p_partkey, -1, p_type, CASE p_type WHEN 'SMALL' THEN '/start' WHEN 'LARGE' THEN 'TOP5'
            WHEN 'PROMO' THEN 'top5' WHEN 'MEDIUM' THEN '{constants.START_WORDS[2]}' ELSE p_name END FROM part)
        SELECT conv_id, turn, kind, CASE WHEN text IN {constants.START_WORDS} THEN 'start'
          WHEN lower(text) = 'top5' THEN 'top_products' ELSE 'cart' END AS intent FROM everything""",
    "chat_steps": _chat(f"{EVENT_CHAT} UNION ALL SELECT 'c' || conv_id, turn, text FROM conversations"),
    "stream_chat_steps": _chat(EVENT_CHAT),
    "stream_top_products": f"""WITH {REQUEST_LINES}
        SELECT name, count(*) AS count FROM lines GROUP BY name ORDER BY count DESC, name LIMIT {constants.TOP_PRODUCTS}""",
    "word_count": "SELECT doc_id, CAST(len(string_split(text, ' ')) AS INTEGER) AS word_count FROM documents",
    "local_date": f"""SELECT event_id, CAST((ts AT TIME ZONE 'UTC') AT TIME ZONE '{constants.LOCAL_ZONE}' AS DATE) AS local_date
        FROM events""",
    "event_time_parts": """SELECT event_id, CAST(hour(ts) AS INTEGER) AS hour, CAST(minute(ts) AS INTEGER) AS minute,
        strftime(ts, '%Y-%m-%dT%H:%M:%S') AS at FROM events""",
    "lexicon_sentiment": f"WITH {SENTIMENT} SELECT doc_id, sentiment FROM sentiments",
    "lexicon_scores": SCORES,
    "stream_lexicon_scores": SCORES,
    "obs_store_join": f"""WITH {OBS}, shops AS ({STORES})
        SELECT chain, store_id, item_code, item_name, price, pulling_date, chain_id, chain_name, store_name, address, city
        FROM obs JOIN shops USING (chain, store_id)""",
    "missing_stores": f"""WITH {STORE_DIM} SELECT chain, store_id FROM store_dim
        WHERE s_suppkey NOT IN (SELECT l_suppkey FROM lineitem)""",
    "store_lookup": f"""WITH {STORE_DIM}, candidates AS (
          SELECT {_padded('s_suppkey')} AS store_id,
            CASE s_nationkey % 3 WHEN 0 THEN 'victory' WHEN 1 THEN 'shufersal' ELSE 'ramilevi' END AS chain FROM supplier)
        SELECT c.store_id || '@' || c.chain AS store_key,
          {_case('c.chain', constants.CHAIN_NAMES)} || ' ' || coalesce(d.s_name, 'store name not found') AS display_name,
          CASE WHEN d.s_suppkey % 6 <> 5 THEN {_lat('d.s_suppkey')} END AS latitude,
          CASE WHEN d.s_suppkey % 6 <> 5 THEN {_lon('d.s_suppkey')} END AS longitude
        FROM candidates c LEFT JOIN store_dim d ON c.store_id = d.store_id AND c.chain = d.chain""",
    "geocode_join": f"""WITH {GEOCODED}
        SELECT c_custkey AS customer_id, full_address, CASE WHEN known THEN {_lat('n_nationkey')} END AS latitude,
          CASE WHEN known THEN {_lon('n_nationkey')} END AS longitude, known AS resolved FROM addressed""",
    "geocode_fuzzy": f"""WITH known AS (
          SELECT lower(c_mktsegment || ' ' || (1 + n_nationkey % 2) || ', ' || n_name) AS full_address, min(n_nationkey) AS place
          FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1),
        typed AS (
          SELECT c_custkey AS customer_id, c_custkey % 4 AS kind, n_name, c_mktsegment || '   ' || (1 + c_custkey % 2) AS address
          FROM customer JOIN nation ON c_nationkey = n_nationkey),
        wrong AS (
          SELECT customer_id, lower(regexp_replace(CASE kind WHEN 1 THEN substr(address, 1, 1) || substr(address, 3)
            WHEN 2 THEN substr(address, 1, 3) || substr(address, 3) WHEN 3 THEN substr(address, 1, 2) || 'xy' || substr(address, 4)
            ELSE address END || ', ' || n_name, '\\s+', ' ', 'g')) AS full_address FROM typed),
        pairs AS (
          SELECT a.full_address, k.full_address AS matched_address, CAST(levenshtein(a.full_address, k.full_address) AS INTEGER) AS edits, place
          FROM (SELECT DISTINCT full_address FROM wrong) a JOIN known k
            ON regexp_extract_all(a.full_address, '\\d+') = regexp_extract_all(k.full_address, '\\d+')
            AND levenshtein(a.full_address, k.full_address) <= 2),
        best AS (SELECT *, row_number() OVER (PARTITION BY full_address ORDER BY edits, matched_address) AS pick FROM pairs)
        SELECT customer_id, w.full_address, matched_address, edits, {_lat('place')} AS latitude, {_lon('place')} AS longitude,
          place IS NOT NULL AS resolved
        FROM wrong w LEFT JOIN best b ON w.full_address = b.full_address AND pick = 1""",
    "unresolved_addresses": f"""WITH {GEOCODED}
        SELECT full_address, count(*) AS rows FROM addressed WHERE NOT known GROUP BY full_address""",
    "latest_file": f"""WITH {OBS}, newest AS (
          SELECT chain, store_id, strftime(max(pulling_date), '%Y%m%d') || '0300' AS stamp FROM obs GROUP BY chain, store_id)
        SELECT 'PriceFull' AS file_type, {_case('chain', constants.CHAIN_IDS)} AS chain_id, store_id,
          'PriceFull' || {_case('chain', constants.CHAIN_IDS)} || '-' || store_id || '-' || stamp || '.gz' AS file_name, stamp
        FROM newest""",
    "product_search": f"""WITH {ALL_DATES}, {_search('''SELECT p_name || ' ' || p_brand AS request FROM part
          UNION ALL SELECT p_name FROM part UNION ALL SELECT string_split(p_name, ' ')[1] FROM part
          UNION ALL SELECT p_brand || ' ' || p_type || ' ' || p_name || ' ' || p_name FROM part''')}
        SELECT request, name, score FROM found""",
    "consolidate": f"WITH {MONTHLY} SELECT snapshot, {LONG} FROM priced",
    "multi_chain_products": f"WITH {MONTHLY} SELECT snapshot, {LONG} FROM priced WHERE chains_count > 1",
    "merge_by_id": f"WITH {MONTHLY} SELECT snapshot, {LONG} FROM cat",
    "flatten_prices": f"WITH {MONTHLY} SELECT snapshot, {LONG} FROM cat",
    "dedup_first": f"""WITH {OBS} SELECT item_name, chain, store_id, item_code, price FROM (
          SELECT *, row_number() OVER (PARTITION BY item_name, chain ORDER BY {ORDER}) AS place FROM obs) WHERE place = 1""",
    "top_products": f"""WITH {REQUEST_LINES}
        SELECT name, count(*) AS count FROM lines GROUP BY name ORDER BY count DESC, name LIMIT {constants.TOP_PRODUCTS}""",
    "basket_cost": f"WITH {ALL_DATES}, {_totals(ORDER_LINES)} SELECT cart_id, chain, store_id, total FROM totals",
    "nearest_stores": f"""WITH {ALL_DATES}, {_totals(ORDER_LINES)}, {_nearest(ORDER_USERS)}
        SELECT cart_id, chain, store_id, store_name, total, distance, rank FROM nearest""",
    "nearest_by_cells": f"""WITH {ALL_DATES}, {_totals(ORDER_LINES)}, {_nearest(ORDER_USERS)}
        SELECT cart_id, chain, store_id, store_name, total, distance, rank FROM nearest""",
    "best_store": f"WITH {ALL_DATES}, {_totals(ORDER_LINES)}, {_nearest(ORDER_USERS)} SELECT * FROM best",
    "message_best_store": f"{ANSWERS} SELECT * FROM best",
    "answer_requests": f"""{ANSWERS}, asked_lists AS (
          SELECT cart_id, '[' || string_agg('{{"name":"' || name || '","product_quantity":"' || quantity_text || '"}}', ',' ORDER BY pos)
            || ']' AS product_list FROM items GROUP BY cart_id)
        SELECT product_list, CAST(cart_id AS VARCHAR) AS user_id, CAST(p_size AS VARCHAR) AS chat_id, p_brand AS user_first_name,
          p_type AS user_last_name, p_name AS user_user_name, {_case('chain', constants.CHAIN_NAMES)} || ' ' || store_name AS min_aff,
          CAST(min_price_all AS VARCHAR) AS min_price
        FROM best JOIN asked_lists USING (cart_id) JOIN part ON p_partkey = cart_id""",
    "price_history": f"""WITH {DAILY} SELECT CAST(date_trunc('month', pulling_date) AS DATE) AS period, name, chain,
        min(price) AS min_price, round(CAST(sum(price) AS DOUBLE) / count(*), 6) AS avg_price, max(price) AS max_price
        FROM daily GROUP BY 1, 2, 3""",
    "price_change": f"""WITH {DAILY}, previous AS (
          SELECT *, lag(price) OVER (PARTITION BY name, chain, store_id ORDER BY pulling_date) AS previous_price FROM daily)
        SELECT pulling_date, name, chain, store_id, price, previous_price, price - previous_price AS change FROM previous""",
    "chain_compare": f"""WITH {DAILY}, lowest AS (
          SELECT CAST(date_trunc('month', pulling_date) AS DATE) AS period, name, chain, min(price) AS price
          FROM daily GROUP BY 1, 2, 3),
        placed AS (SELECT *, row_number() OVER (PARTITION BY period, name ORDER BY price, chain) AS place FROM lowest)
        SELECT period, name, max(CASE WHEN place = 1 THEN chain END) AS cheapest_chain, min(price) AS cheapest_price,
          max(price) - min(price) AS spread, CAST(count(*) AS INTEGER) AS chains_count FROM placed GROUP BY period, name""",
    "price_intervals": INTERVALS,
    "price_intervals_extended": INTERVALS,
    "price_trend": f"""WITH {DAILY},
        lowest AS (SELECT name, chain, pulling_date, min(price) AS price FROM daily GROUP BY name, chain, pulling_date),
        spans AS (
          SELECT *, least(lead(pulling_date) OVER (PARTITION BY name, chain ORDER BY pulling_date), pulling_date + 31) AS upto FROM lowest),
        filled AS (
          SELECT name, chain, price, pulling_date, CAST(unnest(generate_series(pulling_date, upto - 1, INTERVAL 1 DAY)) AS DATE) AS day FROM spans),
        numbered AS (SELECT *, day - DATE '1970-01-01' AS number FROM filled),
        framed AS (
          SELECT *, count(*) OVER frame AS known_days, round(CAST(sum(price) OVER frame AS DOUBLE) / count(*) OVER frame, 6) AS mean_price,
            round(regr_slope(CAST(price AS DOUBLE), CAST(number AS DOUBLE)) OVER frame, 6) AS slope
          FROM numbered WINDOW frame AS (PARTITION BY name, chain ORDER BY number RANGE BETWEEN 27 PRECEDING AND CURRENT ROW))
        SELECT name, chain, day, price, known_days, mean_price, CASE WHEN known_days > 1 THEN slope END AS slope
        FROM framed WHERE day = pulling_date""",
    "chain_rollup": f"""WITH {DAILY}, dated AS (SELECT *, CAST(date_trunc('month', pulling_date) AS DATE) AS period FROM daily)
        SELECT chain, period, name, CAST(GROUPING(chain, period, name) AS INTEGER) AS level, count(*) AS prices, min(price) AS min_price,
          round(CAST(sum(price) AS DOUBLE) / count(*), 6) AS mean_price, max(price) AS max_price
        FROM dated GROUP BY GROUPING SETS ((chain, period, name), (chain, period), (period, name), (period), (chain), ())""",
    "price_as_of": f"""WITH {DAILY}, {_intervals("lag(price) OVER line <> price OR pulling_date - lag(pulling_date) OVER line > 365")},
        asked AS (
          SELECT l_orderkey, l_linenumber, p_name || ' ' || p_brand AS name, chain, store_id, CAST(o_orderdate AS DATE) AS day
          FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN store_dim ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey)
        SELECT a.*, CASE WHEN day - last_seen <= 365 OR last_seen > day THEN price END AS price,
          CASE WHEN day - last_seen <= 365 OR last_seen > day THEN valid_from END AS price_since
        FROM asked a ASOF LEFT JOIN folded f
          ON a.name = f.name AND a.chain = f.chain AND a.store_id = f.store_id AND a.day >= f.valid_from""",
    "stream_ingest": "SELECT event_id, user_id, event_type, value, props FROM events",
    "stream_fanout": """SELECT topic, event_id, user_id, event_type
        FROM events, (VALUES ('archive'), ('data')) AS topics(topic)""",
    "stream_requests": f"""SELECT '[{{"name":"' || p_name || ' ' || p_brand || '","product_quantity":"' || CAST(l_quantity AS INTEGER)
          || '"}},{{"name":"' || p_name || '","product_quantity":"' || l_linenumber || '"}}]' AS product_list,
          CAST(l_orderkey AS VARCHAR) AS user_id, CAST(l_suppkey AS VARCHAR) AS chat_id,
          'first ' || l_returnflag AS user_first_name, 'last ' || l_linestatus AS user_last_name,
          l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS user_user_name,
          {_padded('l_suppkey')} AS min_aff, CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR) AS min_price,
          true AS stamped FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "stream_enrich": f"""WITH {SENTIMENT} SELECT CAST(doc_id AS VARCHAR) AS tweet_id, 'user ' || (doc_id % 1000) AS name,
        CAST(len(string_split(text, ' ')) AS INTEGER) AS wordCount, sentiment, true AS hour_fits
        FROM documents JOIN sentiments USING (doc_id)""",
    "stream_products": f"WITH {ALL_DATES} SELECT {LONG} FROM cat",
    "stream_stores": f"""WITH {STORE_DIM} SELECT s_name AS "StoreName", n_name AS "City", store_id,
        {_case('chain', constants.CHAIN_IDS)} AS "ChainId", {_case('chain', constants.CHAIN_NAMES)} AS "ChainName",
        '2023-01-01' AS pulling_date, CASE WHEN s_suppkey % 6 <> 5 THEN {_lat('s_suppkey')} END AS "Latitude",
        CASE WHEN s_suppkey % 6 <> 5 THEN {_lon('s_suppkey')} END AS "Longitude" FROM store_dim""",
    "stream_insert_if_absent": """SELECT user_id, event_id, event_type, value FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS place FROM events) WHERE place = 1""",
}
