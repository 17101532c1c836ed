"""DuckDB oracles for the registered queries (see ``__spark_entry__.oracle_sql``).

Each oracle recomputes a query's result from the driver's tables in plain SQL.  The SQL
is assembled from small fragments (canonical URL, host, ownership, claim regexes) that
follow the reference semantics in DuckDB's own dialect (RE2 regexes, 1-based lists).
"""

from __future__ import annotations

from sourcelens.functions.urls import USES_NETLOC
from sourcelens.plans import testbed as tb

R = tb.rules()

URL_RE = r"(?s)^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)"
URL_IN_TEXT = r"""https?://[^\s)\]"'>,]+"""


def lit(s) -> str:
    if s is None:
        return "NULL"
    return "'" + str(s).replace("'", "''") + "'"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def host(x: str) -> str:
    return f"regexp_replace(lower(regexp_extract({x}, {lit(URL_RE)}, 2)), '^www\\.', '')"


def path(x: str) -> str:
    return f"regexp_extract({x}, {lit(URL_RE)}, 3)"


def canon(x: str) -> str:
    t = strip(x)
    sch = f"lower(regexp_extract({t}, {lit(URL_RE)}, 1))"
    hst = host(t)
    pth = f"regexp_replace(regexp_extract({t}, {lit(URL_RE)}, 3), '/+$', '')"
    so = f"(CASE WHEN {sch} = '' THEN 'https' ELSE {sch} END)"
    netloc_schemes = ", ".join(lit(s) for s in USES_NETLOC)
    slashes = (f"(CASE WHEN starts_with({pth}, '//') OR ({so} IN ({netloc_schemes}) AND ({pth} = '' OR "
               f"starts_with({pth}, '/'))) THEN '//' ELSE '' END)")
    return (f"(CASE WHEN {sch} = '' AND {hst} = '' THEN {t} "
            f"WHEN {hst} <> '' THEN {so} || '://' || {hst} || {pth} "
            f"ELSE {so} || ':' || {slashes} || {pth} END)")


def under(h: str, domains) -> str:
    if not domains:
        return "false"
    return "(" + " OR ".join(f"({h} = {lit(d)} OR ends_with({h}, {lit('.' + d)}))" for d in domains) + ")"


def nonprod(h: str) -> str:
    strict = " OR ".join(f"ends_with({h}, {lit('.' + d)})" for d in R.owned_domains)
    prefixes = ", ".join(lit(p) for p in R.nonprod_prefixes)
    return f"(({strict}) AND split_part({h}, '.', 1) IN ({prefixes}))"


def ownership(url: str, h: str) -> str:
    apps = ", ".join(lit(a) for a in R.app_store_hosts)
    app_hit = " OR ".join(f"contains({url}, {lit(a)})" for a in R.owned_app_ids) or "false"
    return (f"(CASE WHEN {under(h, R.competitor_domains)} THEN 'competitor' "
            f"WHEN {h} IN ({apps}) THEN (CASE WHEN {app_hit} THEN 'owned' ELSE 'third_party' END) "
            f"WHEN {under(h, R.owned_domains)} THEN 'owned' "
            f"WHEN {h} = {lit(R.marketplace_host)} AND contains({url}, {lit(R.marketplace_marker)}) "
            f"THEN 'owned_marketplace' ELSE 'third_party' END)")


def claim(text: str, patterns) -> str:
    lt = f"lower(coalesce({text}, ''))"
    return "(" + " OR ".join(f"regexp_matches({lt}, {lit(p)})" for p in patterns) + ")"


def stale(text: str) -> str:
    pats = dict(R.claim_patterns)
    return "(" + " OR ".join(claim(text, pats[n]) for n in R.stale_claim_names) + ")"


def brand_hits(text: str):
    lt = f"lower(coalesce({text}, ''))"
    return [(b, f"contains({lt}, {lit(b.lower())})") for b in R.competitor_brands]


def comps_joined(text: str, sep: str) -> str:
    return "concat_ws(" + lit(sep) + ", " + ", ".join(f"CASE WHEN {c} THEN {lit(b)} END" for b, c in brand_hits(text)) + ")"


def any_comp(text: str) -> str:
    return "(" + " OR ".join(c for _, c in brand_hits(text)) + ")"


def mentions(text: str) -> str:
    return f"contains(lower(coalesce({text}, '')), {lit(R.brand_lower)})"


def prices_list(text: str) -> str:
    return f"list_sort(list_distinct(regexp_extract_all(coalesce({text}, ''), {lit(R.price_pattern)})))"


def urls_in(text: str) -> str:
    return f"regexp_extract_all(coalesce({text}, ''), {lit(URL_IN_TEXT)})"


def asset(n: str) -> str:
    p = f"lower({path(n)})"
    h = f"lower({host(n)})"
    return "(" + " OR ".join([f"ends_with({p}, {lit(e)})" for e in R.asset_ext]
                             + [f"contains({h}, {lit(x)})" for x in R.asset_hosts]) + ")"


def narrative(st: str, text: str, note: str) -> str:
    return (f"(CASE WHEN {st} THEN {lit(note)} WHEN {mentions(text)} THEN {lit(R.mentions_note())} "
            f"ELSE {lit(R.no_mention_note())} END)")


def dedupe_rank(rank: str) -> str:
    return f"CASE WHEN coalesce({rank}, 0) = 0 THEN 1 ELSE 0 END, coalesce({rank}, 0)"


# ---------------------------------------------------------------------------
# shared CTEs (derived inputs, as in sourcelens.plans.testbed)
# ---------------------------------------------------------------------------
N_PAGES = "(SELECT count(*) FROM pages)"


def cte_records() -> str:
    return f"""
base AS (
  SELECT page_id, url, regexp_extract(html, '<title>(.*?)</title>', 1) AS title,
         regexp_extract(url, '^https?://[^/]+/([a-z]{{2}})/', 1) AS query FROM pages),
recs AS (
  SELECT url, 'web' AS platform, query, CAST(doc_id % 20 + 1 AS BIGINT) AS rank, title,
         coalesce(text, '') AS snippet, 0 AS source_ord, doc_id AS seq
  FROM documents JOIN base ON page_id = doc_id % {N_PAGES}
  UNION ALL
  SELECT url, 'news', query, CAST(page_id % 7 + 1 AS BIGINT), title, title, 1, page_id FROM base
  UNION ALL
  SELECT url, 'reddit', 'reddit', CAST(0 AS BIGINT), title, coalesce(text, ''), 3, conv_id * 1000 + turn
  FROM conversations JOIN base ON page_id = conv_id % {N_PAGES})"""


def cte_cache(as_of: str = tb.AS_OF, p: str = "") -> str:
    return f"""
{p}cache AS (
  SELECT {canon('url')} AS url, html AS text,
         CAST(DATE '{tb.AS_OF}' - CAST(page_id % 20 AS INTEGER) AS DATE) AS fetch_date, page_id AS seq FROM pages),
{p}fresh AS (
  SELECT url, text, fetch_date FROM (
    SELECT url, coalesce(text, '') AS text, fetch_date,
           row_number() OVER (PARTITION BY url ORDER BY fetch_date DESC, seq DESC) AS rn
    FROM {p}cache WHERE fetch_date >= DATE '{as_of}' - 7) WHERE rn = 1)"""


def cte_crawled() -> str:
    return f"""
crawled_all AS (
  SELECT url, text FROM (
    SELECT {canon('p.url')} AS url, d.text,
           row_number() OVER (PARTITION BY {canon('p.url')} ORDER BY d.doc_id DESC) AS rn
    FROM pages p JOIN documents d ON d.doc_id % {N_PAGES} = p.page_id) WHERE rn = 1)"""


def cte_answers() -> str:
    return """
cu AS (SELECT conv_id, turn, text AS prompt FROM conversations WHERE role <> 'assistant'),
ca AS (SELECT conv_id, turn - 1 AS turn, text AS answer FROM conversations WHERE role = 'assistant'),
cj AS (SELECT cu.conv_id, cu.turn, cu.prompt, ca.answer FROM cu LEFT JOIN ca ON ca.conv_id = cu.conv_id AND ca.turn = cu.turn),
pg AS (SELECT page_id, url FROM pages),
ans AS (
  SELECT cj.conv_id, cj.turn,
         CASE WHEN cj.conv_id % 2 = 0 THEN 'chatgpt' ELSE 'perplexity' END AS surface,
         CAST(1 AS BIGINT) AS run, cj.prompt,
         CASE WHEN cj.answer IS NULL THEN '' ELSE concat_ws(' ', cj.answer, 'See', p1.url, 'and (', p2.url, ').') END
           AS response,
         CASE WHEN p3.url IS NULL THEN CAST([] AS VARCHAR[]) ELSE [p3.url, p1.url] END AS citations,
         CAST(NULL AS VARCHAR) AS error
  FROM cj
  LEFT JOIN pg p1 ON p1.page_id = cj.conv_id
  LEFT JOIN pg p2 ON p2.page_id = cj.conv_id + 100 + cj.turn
  LEFT JOIN pg p3 ON p3.page_id = cj.conv_id * 2 + cj.turn)"""


def status_sql(response: str, error: str) -> str:
    blank = strip(f"coalesce({response}, '')")
    return f"(CASE WHEN {error} IS NOT NULL THEN 'error' WHEN {blank} = '' THEN 'empty' ELSE 'ok' END)"


def sources_ctes(src: str, out: str, text: str, extra: str, verdict: str) -> str:
    """U4 over rows of ``src``: verdict sources ++ extra ++ text URLs -> http only -> canonical ->
    ordered distinct ; plus the non-production flag."""
    return f"""
{out}_a AS (
  SELECT *, list_transform(list_filter(list_concat(list_concat({verdict}, {extra}), {urls_in(text)}),
                                       lambda s: s IS NOT NULL AND starts_with(s, 'http')),
                           lambda s: {canon('s')}) AS _cl FROM {src}),
{out} AS (
  SELECT * EXCLUDE (_cl), list_filter(_cl, lambda x, i: list_position(_cl, x) = i) AS srcs FROM {out}_a)"""


def web_ctes(as_of: str, p: str) -> str:
    """The web snapshot (E2) as CTEs prefixed ``p``; the sheet is ``{p}sheet``."""
    topics = ", ".join(f"({lit(t['id'])}, {lit(t['intent'])}, {lit(t['query'])}, {i})"
                       for i, t in enumerate(tb.LANG_TOPICS))
    return f"""
{p}topics AS (
  SELECT id, intent, query FROM (
    SELECT *, row_number() OVER (PARTITION BY query ORDER BY seq DESC) AS rn
    FROM (VALUES {topics}) t(id, intent, query, seq)) WHERE rn = 1),
{p}tagged AS (
  SELECT r.*, coalesce(t.intent, 'unknown') AS intent, coalesce(t.id, '') AS topic_id
  FROM recs r LEFT JOIN {p}topics t ON t.query = r.query WHERE r.platform <> 'reddit'
  UNION ALL
  SELECT r.*, 'community', '' FROM recs r WHERE r.platform = 'reddit'),
{p}best AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY url ORDER BY {dedupe_rank('rank')}, source_ord, seq) AS rn
    FROM (SELECT * EXCLUDE (url), url AS raw_url, {canon('url')} AS url FROM {p}tagged)) WHERE rn = 1),
{cte_cache(as_of, p).strip()},
{p}req AS (SELECT DISTINCT url FROM {p}best WHERE starts_with(url, 'http')),
{p}hits AS (SELECT r.url, f.text FROM {p}req r JOIN {p}fresh f ON f.url = r.url),
{p}misses AS (SELECT url FROM {p}req WHERE url NOT IN (SELECT url FROM {p}fresh)),
{p}crawled AS (SELECT c.url, c.text FROM crawled_all c WHERE c.url IN (SELECT url FROM {p}misses)),
{p}bodies AS (
  SELECT coalesce(h.url, c.url) AS url, coalesce(c.text, h.text) AS text
  FROM {p}hits h FULL OUTER JOIN {p}crawled c ON c.url = h.url),
{p}enriched AS (
  SELECT b.*, CASE WHEN length(coalesce(x.text, '')) >= length(coalesce(b.snippet, '')) THEN coalesce(x.text, '')
                   ELSE coalesce(b.snippet, '') END AS body,
         CASE WHEN b.url IN (SELECT url FROM {p}hits) THEN 'cache'
              WHEN b.url IN (SELECT url FROM {p}crawled) THEN 'crawl'
              WHEN b.url IN (SELECT url FROM {p}misses) THEN 'missing' ELSE 'none' END AS fetch_status
  FROM {p}best b LEFT JOIN {p}bodies x ON x.url = b.url),
{p}verdicts AS (
  SELECT key, says, mc, comps, sentiment FROM (
    SELECT {canon('p.url')} AS key,
           CASE WHEN l.quality = 1 THEN 'Good page.' ELSE 'Weak page.' END AS says,
           l.toxic = 1 AS mc, CASE WHEN l.toxic = 1 THEN 'There' ELSE '' END AS comps,
           CAST(l.quality - l.toxic AS DOUBLE) AS sentiment,
           row_number() OVER (PARTITION BY {canon('p.url')} ORDER BY l.doc_id DESC) AS rn
    FROM pages p JOIN labels l ON l.doc_id % {N_PAGES} = p.page_id) WHERE rn = 1),
{p}lab AS (
  SELECT e.*, {stale('e.body')} AS st, {prices_list('e.body')} AS prices, {comps_joined('e.body', '; ')} AS cj,
         {comps_joined('e.body', ', ')} AS cn, {any_comp('e.body')} AS anyc,
         v.key IS NOT NULL AND e.body <> '' AS has_v, v.says, v.mc, v.comps, v.sentiment AS v_sent,
         {host('e.url')} AS h, CASE WHEN coalesce(e.url, '') = '' THEN NULL ELSE {host('e.url')} END AS ph,
         coalesce(nullif(e.raw_url, ''), e.url) AS lu
  FROM {p}enriched e LEFT JOIN {p}verdicts v ON v.key = e.url),
{p}links0 AS (
  SELECT *, list_transform({urls_in('body')}, lambda x: {canon('x')}) AS _cl FROM {p}lab),
{p}links1 AS (
  SELECT * EXCLUDE (_cl),
         list_filter(_cl, lambda n: n <> '' AND NOT coalesce({host('n')} = ph, false) AND NOT {asset('n')}) AS _fl
  FROM {p}links0),
{p}sheet AS (
  SELECT platform AS source, url, coalesce(query, '') AS query, coalesce(intent, '') AS intent,
         coalesce(topic_id, '') AS topic_id, {ownership('lu', host('lu'))} AS ownership,
         CASE WHEN has_v THEN coalesce(says, '') ELSE {narrative('st', 'body', R.stale_note_web)} END
           AS says_about_brand,
         CASE WHEN has_v THEN coalesce(mc, false) ELSE anyc END AS mentions_competition,
         CASE WHEN has_v THEN '' WHEN cn <> '' THEN 'Names: ' || cn ELSE '' END AS competition_summary,
         CASE WHEN has_v THEN comps ELSE cj END AS competitors_named,
         CASE WHEN has_v THEN coalesce(v_sent, 0.0) ELSE 0.0 END AS sentiment,
         prices[1] AS price,
         array_to_string(list_filter(_fl, lambda x, i: list_position(_fl, x) = i), ', ') AS links_on_source,
         {nonprod('h')} AS nonprod_url, coalesce(title, '') AS title,
         CASE WHEN has_v THEN 'model' ELSE 'fallback' END AS verdict_source, fetch_status
  FROM {p}links1)"""


WEB_COLS = ("source, url, query, intent, topic_id, ownership, says_about_brand, mentions_competition, "
            "competition_summary, competitors_named, sentiment, price, links_on_source, nonprod_url, title")


def answers_ctes() -> str:
    """The answer snapshot (E4) as CTEs; the sheet (with ``stale``) is ``asheet``."""
    prompts = """
prompts AS (
  SELECT prompt, 'conv' AS intent, topic_id FROM (
    SELECT text AS prompt, 'c' || CAST(conv_id AS VARCHAR) || '_' || CAST(turn AS VARCHAR) AS topic_id,
           row_number() OVER (PARTITION BY text ORDER BY conv_id, turn) AS rn
    FROM conversations WHERE role <> 'assistant') WHERE rn = 1),
manifest AS (
  SELECT s.surface, CAST(g.run AS BIGINT) AS run, pr.prompt, pr.intent, pr.topic_id
  FROM prompts pr CROSS JOIN (VALUES ('chatgpt'), ('perplexity'), ('gemini')) s(surface)
  CROSS JOIN generate_series(1, 2) g(run)),"""
    return prompts + cte_answers() + f""",
aok AS (
  SELECT a.surface, a.run, a.prompt, a.response, a.citations, a.error,
         coalesce(pr.intent, 'unknown') AS intent, coalesce(pr.topic_id, '') AS topic_id,
         {status_sql('a.response', 'a.error')} AS status
  FROM ans a LEFT JOIN prompts pr ON pr.prompt = a.prompt
  WHERE a.surface IN ('chatgpt', 'perplexity') AND a.error IS NULL),
alab AS (
  SELECT *, {stale('response')} AS st, {comps_joined('response', '; ')} AS cj, {comps_joined('response', ', ')} AS cn,
         {any_comp('response')} AS anyc, {urls_in('response')} AS fb_src FROM aok),
{sources_ctes('alab', 'asrc', 'response', 'citations', 'fb_src').strip()},
arows AS (
  SELECT surface, run, prompt, intent, topic_id,
         CASE WHEN status = 'ok' THEN {mentions('response')} END AS mentioned,
         CAST(NULL AS BIGINT) AS rank,
         CASE WHEN status = 'ok' THEN false END AS recommended,
         CASE WHEN status = 'ok' THEN {narrative('st', 'response', R.stale_note_answer)} ELSE '' END AS says_about_brand,
         CASE WHEN status = 'ok' THEN anyc END AS mentions_competition,
         CASE WHEN status = 'ok' AND cn <> '' THEN 'Names: ' || cn ELSE '' END AS competition_summary,
         CASE WHEN status = 'ok' THEN cj ELSE '' END AS competitors_named,
         CASE WHEN status = 'ok' THEN CAST(0.0 AS DOUBLE) END AS sentiment,
         CAST(NULL AS VARCHAR) AS price,
         CASE WHEN status = 'ok' THEN array_to_string(srcs, ', ') ELSE '' END AS sources_cited,
         CASE WHEN status = 'ok' THEN len(list_filter(srcs, lambda s: {nonprod(host('s'))})) > 0 ELSE false END
           AS nonprod_url,
         CASE WHEN status = 'ok' THEN response ELSE '' END AS response_text,
         status,
         CASE WHEN status = 'empty' THEN 'returned no answer text' ELSE '' END AS error_note,
         CASE WHEN status = 'ok' THEN st END AS stale
  FROM asrc),
fails AS (SELECT * FROM (VALUES ('perplexity', CAST(2 AS BIGINT), CAST(NULL AS VARCHAR), 'api 500'))
          f(surface, run, prompt, note)),
aerr AS (
  SELECT surface, run, prompt, intent, topic_id, 'unknown surface ''' || surface || '''' AS note
  FROM manifest WHERE surface NOT IN ('chatgpt', 'perplexity')
  UNION ALL
  SELECT m.surface, m.run, m.prompt, m.intent, m.topic_id, f.note
  FROM manifest m JOIN fails f ON m.surface = f.surface AND m.run = f.run AND (f.prompt IS NULL OR m.prompt = f.prompt)
  WHERE m.surface IN ('chatgpt', 'perplexity')),
asheet AS (
  SELECT * FROM arows
  UNION ALL
  SELECT surface, run, prompt, intent, topic_id, NULL, NULL, NULL, '', NULL, '', '', NULL, NULL, '', false, '',
         'error', coalesce(note, ''), NULL
  FROM aerr)"""


LLM_COLS = ("surface, run, prompt, intent, topic_id, mentioned, rank, recommended, says_about_brand, "
            "mentions_competition, competition_summary, competitors_named, sentiment, price, sources_cited, "
            "nonprod_url, response_text, status, error_note")


def link_body_cte() -> str:
    return f"""
lp AS (SELECT page_id, url FROM pages),
lb AS (
  SELECT p.page_id, p.url,
         concat_ws(' ', 'Read', q1.url, 'and', '(' || q2.url || ')', 'logo',
                   'https://cdn.example.com/img/' || CAST(p.page_id AS VARCHAR) || '.PNG', 'px',
                   'https://stats.doubleclick.net/p/' || CAST(p.page_id AS VARCHAR), 'tag',
                   'https://www.googletagmanager.com/gtm.js?id=' || CAST(p.page_id AS VARCHAR), 'home',
                   'https://' || {host('p.url')} || '/about', 'more', q5.url || '.', 'again', q1.url) AS text
  FROM lp p
  LEFT JOIN lp q1 ON q1.page_id = p.page_id + 1
  LEFT JOIN lp q2 ON q2.page_id = p.page_id + 2
  LEFT JOIN lp q5 ON q5.page_id = p.page_id + 5),
l0 AS (
  SELECT page_id, CASE WHEN coalesce(url, '') = '' THEN NULL ELSE {host('url')} END AS ph,
         list_transform({urls_in('text')}, lambda x: {canon('x')}) AS _cl FROM lb),
l1 AS (SELECT page_id, list_filter(_cl, lambda n: n <> '' AND NOT coalesce({host('n')} = ph, false)
                                              AND NOT {asset('n')}) AS _fl FROM l0),
l2 AS (SELECT page_id, list_filter(_fl, lambda x, i: list_position(_fl, x) = i) AS links FROM l1)"""


def price_text_cte() -> str:
    return """
pt AS (
  SELECT p_partkey, p_brand,
         p_name || ' now $' || CAST(CAST(floor(p_retailprice) AS BIGINT) AS VARCHAR) || ' (was $ '
         || CAST(CAST(floor(p_retailprice) AS BIGINT) + p_size AS VARCHAR) || '), ships $'
         || CAST(p_size AS VARCHAR) || ', code $' || CAST(p_partkey AS VARCHAR) AS text
  FROM part)"""


def manifest_cte() -> str:
    surfaces = ", ".join(f"({lit(s)})" for s in tb.SURFACES)
    return f"""
mp AS (SELECT n.n_name AS prompt, lower(r.r_name) AS intent, 'n' || CAST(n.n_nationkey AS VARCHAR) AS topic_id
       FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey),
manifest AS (
  SELECT s.surface, CAST(g.run AS BIGINT) AS run, mp.prompt, mp.intent, mp.topic_id
  FROM mp CROSS JOIN (VALUES {surfaces}) s(surface) CROSS JOIN generate_series(1, {tb.NUM_RUNS}) g(run))"""


def catalog_ctes() -> str:
    sel = ", ".join(f"(CAST({i} AS BIGINT), {lit(t)})" for i, t in enumerate(tb.SELECTORS))
    return f"""
cat AS (SELECT p_partkey + 1 AS pos, p_name AS label FROM part),
sel AS (SELECT * FROM (VALUES {sel}) s(ord, token)),
cm AS (
  SELECT c.pos, c.label, s.ord FROM cat c JOIN sel s
  ON (regexp_full_match(s.token, '[0-9]+') AND c.pos = TRY_CAST(s.token AS BIGINT))
  OR (NOT regexp_full_match(s.token, '[0-9]+') AND contains(lower(c.label), lower(s.token)))),
chosen AS (
  SELECT label, ord AS sel_ord, pos FROM (
    SELECT *, row_number() OVER (PARTITION BY label ORDER BY ord, pos) AS rn FROM cm) WHERE rn = 1)"""


def oracle_queries() -> dict[str, str]:
    q: dict[str, str] = {}
    q["canonical_urls"] = (f"SELECT page_id, url, {canon('url')} AS canon_url, {host('url')} AS host, "
                           f"{path(canon('url'))} AS path FROM pages")
    q["dedupe_best"] = f"""WITH {cte_records().strip()}
SELECT url, platform, rank, page_id FROM (
  SELECT {canon('url')} AS url, platform, rank, seq AS page_id,
         row_number() OVER (PARTITION BY {canon('url')} ORDER BY {dedupe_rank('rank')}, source_ord, seq) AS rn
  FROM recs) WHERE rn = 1"""
    parts = f"pp AS (SELECT page_id, url, {canon('url')} AS canon_url FROM pages), " \
            f"ph AS (SELECT *, {host('canon_url')} AS host FROM pp)"
    q["ownership_labels"] = f"WITH {parts} SELECT page_id, canon_url, host, {ownership('url', 'host')} AS ownership FROM ph"
    q["ownership_suffix_join"] = q["ownership_labels"]
    q["nonprod_flags"] = f"WITH {parts} SELECT page_id, canon_url, host, {nonprod('host')} AS nonprod_url FROM ph"
    q["nonprod_report"] = (f"WITH {parts} SELECT DISTINCT canon_url AS url FROM ph WHERE {nonprod('host')}")
    claims = ", ".join(f"{claim('text', pats)} AS {name}" for name, pats in R.claim_patterns)
    q["claim_flags"] = (f"SELECT doc_id, {claims}, {claim('text', R.current_signal_patterns)} AS current_signal, "
                        f"{stale('text')} AS stale FROM documents")
    q["brands_in"] = (f"SELECT doc_id, {comps_joined('text', '; ')} AS competitors_named, "
                      f"{any_comp('text')} AS mentions_competition, {mentions('text')} AS mentions_brand FROM documents")
    q["brand_mentions_long"] = " UNION ALL ".join(
        f"SELECT doc_id, CAST({i + 1} AS INTEGER) AS brand_pos, {lit(b)} AS brand FROM documents WHERE {c}"
        for i, (b, c) in enumerate(brand_hits("text")))
    q["price_mentions"] = f"""WITH {price_text_cte().strip()},
pl AS (SELECT p_partkey, {prices_list('text')} AS ps FROM pt)
SELECT p_partkey, array_to_string(ps, ', ') AS prices_seen, ps[1] AS price_first, CAST(len(ps) AS BIGINT) AS n_prices
FROM pl"""
    q["price_brand_top5"] = f"""WITH {price_text_cte().strip()},
ex AS (SELECT DISTINCT p_brand, price FROM (
  SELECT p_brand, unnest(regexp_extract_all(text, {lit(R.price_pattern)})) AS price FROM pt))
SELECT p_brand, price, price_rank FROM (
  SELECT p_brand, price, CAST(row_number() OVER (PARTITION BY p_brand ORDER BY price) AS BIGINT) AS price_rank FROM ex)"""
    q["outbound_links"] = f"""WITH {link_body_cte().strip()}
SELECT page_id, array_to_string(links, ', ') AS links_on_source, CAST(len(links) AS BIGINT) AS n_links FROM l2"""
    q["link_table"] = f"""WITH {link_body_cte().strip()},
lt AS (SELECT page_id, unnest(links) AS link_url, unnest(generate_series(1, len(links))) AS link_pos FROM l2)
SELECT page_id, CAST(link_pos AS BIGINT) AS link_pos, link_url, {host('link_url')} AS link_host FROM lt"""
    q["richer_text"] = """WITH j AS (
  SELECT d.doc_id, coalesce(d.text, '') AS snip,
         CASE WHEN length(coalesce(c.text, '')) >= length(coalesce(d.text, '')) THEN coalesce(c.text, '')
              ELSE coalesce(d.text, '') END AS best
  FROM documents d LEFT JOIN (SELECT conv_id, string_agg(text, ' ' ORDER BY turn) AS text FROM conversations GROUP BY conv_id) c
  ON c.conv_id = d.doc_id)
SELECT doc_id, CASE WHEN best = snip THEN 'snippet' ELSE 'body' END AS best_from, best FROM j"""
    q["cache_fresh"] = f"""WITH {cte_cache().strip()}
SELECT url, strftime(fetch_date, '%Y-%m-%d') AS fetch_date, CAST(length(text) AS BIGINT) AS text_chars FROM fresh"""
    req = f"req AS (SELECT DISTINCT {canon('url')} AS url FROM pages WHERE starts_with({canon('url')}, 'http'))"
    q["cache_split"] = f"""WITH {cte_cache().strip()}, {req}
SELECT r.url, CASE WHEN f.url IS NOT NULL THEN 'hit' ELSE 'miss' END AS status
FROM req r LEFT JOIN fresh f ON f.url = r.url"""
    q["cache_upsert"] = f"""WITH {cte_cache().strip()}, {req}, {cte_crawled().strip()},
misses AS (SELECT url FROM req WHERE url NOT IN (SELECT url FROM fresh)),
batch AS (SELECT url, coalesce(text, '') AS text, DATE '{tb.AS_OF}' AS fetch_date FROM crawled_all
          WHERE url IN (SELECT url FROM misses)),
nxt AS (SELECT url, text, fetch_date FROM cache WHERE url NOT IN (SELECT url FROM batch)
        UNION ALL SELECT url, text, fetch_date FROM batch)
SELECT url, strftime(fetch_date, '%Y-%m-%d') AS fetch_date, CAST(length(text) AS BIGINT) AS text_chars
FROM nxt WHERE fetch_date >= DATE '{tb.AS_OF}' - 14"""
    topics = ", ".join(f"({lit(t['id'])}, {lit(t['intent'])}, {lit(t['query'])}, {i})"
                       for i, t in enumerate(tb.EVENT_TOPICS))
    q["topic_tag"] = f"""WITH c AS (
  SELECT id, intent, query FROM (
    SELECT *, row_number() OVER (PARTITION BY query ORDER BY seq DESC) AS rn
    FROM (VALUES {topics}) t(id, intent, query, seq)) WHERE rn = 1)
SELECT e.event_id, e.event_type AS query, coalesce(c.intent, 'unknown') AS intent, coalesce(c.id, '') AS topic_id
FROM events e LEFT JOIN c ON c.query = e.event_type"""
    q["props_json"] = ("SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, "
                       "coalesce(json_extract_string(props, '$.term'), props) AS query FROM events")
    q["request_manifest"] = f"WITH {manifest_cte().strip()} SELECT surface, run, prompt, intent, topic_id FROM manifest"
    fails = ", ".join(f"({lit(s)}, CAST({r} AS BIGINT), CAST({lit(p)} AS VARCHAR), {lit(n)})"
                      for s, r, p, n in tb.FAILURES)
    known = ", ".join(lit(s) for s in tb.KNOWN_SURFACES)
    q["error_rows"] = f"""WITH {manifest_cte().strip()},
fails AS (SELECT * FROM (VALUES {fails}) f(surface, run, prompt, note)),
e AS (
  SELECT surface, run, prompt, intent, topic_id, 'unknown surface ''' || surface || '''' AS note
  FROM manifest WHERE surface NOT IN ({known})
  UNION ALL
  SELECT m.surface, m.run, m.prompt, m.intent, m.topic_id, f.note
  FROM manifest m JOIN fails f ON m.surface = f.surface AND m.run = f.run AND (f.prompt IS NULL OR m.prompt = f.prompt)
  WHERE m.surface IN ({known}))
SELECT surface, run, prompt, intent, topic_id, 'error' AS status, coalesce(note, '') AS error_note FROM e"""
    q["answer_status"] = f"""WITH {cte_answers().strip()}
SELECT conv_id, turn, surface, run, {status_sql('response', 'error')} AS status FROM ans"""
    q["verdict_merge"] = f"""WITH lab AS (
  SELECT doc_id, CASE WHEN quality = 1 THEN 'Good page.' ELSE 'Weak page.' END AS says, toxic = 1 AS mc,
         CASE WHEN toxic = 1 THEN 'There' ELSE '' END AS comps, CAST(quality - toxic AS DOUBLE) AS sentiment
  FROM labels),
d AS (
  SELECT d.doc_id, d.text, {stale('d.text')} AS st, {comps_joined('d.text', '; ')} AS cj,
         {comps_joined('d.text', ', ')} AS cn, {any_comp('d.text')} AS anyc, {prices_list('d.text')} AS prices,
         l.doc_id IS NOT NULL AND d.text <> '' AS has_v, l.says, l.mc, l.comps, l.sentiment AS v_sent
  FROM documents d LEFT JOIN lab l ON l.doc_id = d.doc_id)
SELECT doc_id, CASE WHEN has_v THEN 'model' ELSE 'fallback' END AS verdict_source,
       CASE WHEN has_v THEN says ELSE {narrative('st', 'text', R.stale_note_web)} END AS says_about_brand,
       CASE WHEN has_v THEN mc ELSE anyc END AS mentions_competition,
       CASE WHEN has_v THEN '' WHEN cn <> '' THEN 'Names: ' || cn ELSE '' END AS competition_summary,
       CASE WHEN has_v THEN comps ELSE cj END AS competitors_named,
       CASE WHEN has_v THEN v_sent ELSE 0.0 END AS sentiment,
       prices[1] AS price
FROM d"""
    q["citations_merge"] = f"""WITH {cte_answers().strip()},
aa AS (SELECT conv_id, turn, response, citations, {urls_in('response')} AS fb_src FROM ans WHERE response <> ''),
{sources_ctes('aa', 's', 'response', 'citations', 'fb_src').strip()}
SELECT conv_id, turn, array_to_string(srcs, ', ') AS sources_cited,
       len(list_filter(srcs, lambda x: {nonprod(host('x'))})) > 0 AS nonprod_url, CAST(len(srcs) AS BIGINT) AS n_sources
FROM s"""
    q["catalog_select"] = f"WITH {catalog_ctes().strip()} SELECT label, sel_ord, pos FROM chosen"
    q["adhoc_prompts"] = f"""WITH {catalog_ctes().strip()},
ex AS (
  SELECT {strip('text')} AS prompt, coalesce({strip('intent')}, '') AS intent, ord FROM (
    SELECT CASE WHEN p_size <= 3 THEN p_name WHEN p_size >= 48 THEN '  ' ELSE p_type || ' vs ' || p_brand END AS text,
           CASE WHEN p_size % 2 = 0 THEN ' ' ELSE 'comparison' END AS intent, p_partkey AS ord FROM part)),
first AS (
  SELECT prompt, intent FROM (
    SELECT *, row_number() OVER (PARTITION BY prompt ORDER BY ord) AS rn FROM ex WHERE prompt <> '') WHERE rn = 1)
SELECT prompt, CASE WHEN intent = '' THEN 'adhoc' ELSE intent END AS intent, '' AS topic_id
FROM first WHERE prompt NOT IN (SELECT label FROM chosen)"""
    web = f"WITH {cte_records().strip()}, {cte_crawled().strip()}, {web_ctes(tb.AS_OF, 'w_').strip()}"
    q["web_snapshot"] = f"{web} SELECT {WEB_COLS}, verdict_source FROM w_sheet"
    ans = f"WITH {answers_ctes().strip()}"
    flags = ("mentioned", "rank", "recommended", "mentions_competition")
    cols = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" if c in flags else c for c in LLM_COLS.replace(" ", "").split(","))
    cols_text = cols
    q["answer_snapshot"] = f"{ans} SELECT {cols_text} FROM asheet"
    q["visibility_rollup"] = f"""{ans}
SELECT surface, prompt, CAST(count(*) AS BIGINT) AS runs, CAST(count_if(status = 'ok') AS BIGINT) AS ok_runs,
       CAST(count_if(status = 'ok' AND mentioned) AS BIGINT) AS mentioned_runs, CAST(count_if(status = 'ok' AND recommended) AS BIGINT) AS recommended_runs,
       CAST(count_if(status = 'ok' AND coalesce(stale, false)) AS BIGINT) AS stale_runs,
       CASE WHEN CAST(count_if(status = 'ok') AS BIGINT) > 0
            THEN round(CAST(count_if(status = 'ok' AND mentioned) AS BIGINT) / CAST(count_if(status = 'ok') AS BIGINT), 4) END AS mention_rate
FROM asheet GROUP BY surface, prompt"""
    q["ownership_rollup"] = f"""{web}
SELECT ownership, intent, CAST(count(*) AS BIGINT) AS rows, CAST(count_if(mentions_competition) AS BIGINT) AS competition_rows,
       CAST(count_if(nonprod_url) AS BIGINT) AS nonprod_rows, CAST(count_if(price IS NOT NULL) AS BIGINT) AS priced_rows,
       CAST(count_if(verdict_source = 'model') AS BIGINT) AS model_rows
FROM w_sheet GROUP BY ROLLUP (ownership, intent)"""
    q["citation_rollup"] = f"""{ans},
c AS (SELECT {host('src')} AS host FROM (
        SELECT unnest(string_split(sources_cited, ', ')) AS src FROM asheet WHERE status = 'ok') WHERE src <> '')
SELECT host, CAST(count(*) AS BIGINT) AS citations, round(count(*) / (SELECT count(*) FROM c), 4) AS share
FROM c GROUP BY host"""
    cols = [c.strip() for c in WEB_COLS.split(",") if c.strip() != "url"]
    diffs = ", ".join(f"CASE WHEN a.{c} IS DISTINCT FROM b.{c} THEN {lit(c)} END" for c in cols)
    anydiff = " OR ".join(f"a.{c} IS DISTINCT FROM b.{c}" for c in cols)
    q["snapshot_diff"] = f"""WITH {cte_records().strip()}, {cte_crawled().strip()},
{web_ctes('2024-01-20', 'a_').strip()},
{web_ctes('2024-01-24', 'b_').strip()}
SELECT coalesce(a.url, b.url) AS url,
       CASE WHEN a.url IS NULL THEN 'added' WHEN b.url IS NULL THEN 'removed'
            WHEN {anydiff} THEN 'changed' ELSE 'same' END AS change,
       CASE WHEN a.url IS NOT NULL AND b.url IS NOT NULL THEN concat_ws(',', {diffs}) ELSE '' END AS changed_columns
FROM a_sheet a FULL OUTER JOIN b_sheet b ON a.url = b.url"""
    q["score_against_gold"] = f"""WITH j AS (
  SELECT {any_comp('d.text')} AS p_mc, {mentions('d.text')} AS p_mb,
         coalesce(l.toxic = 1, false) AS g_mc, coalesce(l.quality = 1, false) AS g_mb
  FROM documents d JOIN labels l ON l.doc_id = d.doc_id)
SELECT 'mentions_competition' AS field, CAST(count_if(p_mc AND g_mc) AS BIGINT) AS tp, CAST(count_if(p_mc AND NOT g_mc) AS BIGINT) AS fp,
       CAST(count_if(NOT p_mc AND g_mc) AS BIGINT) AS fn, CAST(count_if(NOT p_mc AND NOT g_mc) AS BIGINT) AS tn FROM j
UNION ALL
SELECT 'mentions_brand', CAST(count_if(p_mb AND g_mb) AS BIGINT), CAST(count_if(p_mb AND NOT g_mb) AS BIGINT), CAST(count_if(NOT p_mb AND g_mb) AS BIGINT),
       CAST(count_if(NOT p_mb AND NOT g_mb) AS BIGINT) FROM j"""
    q["scored_verdicts"] = f"""WITH d AS (
  SELECT doc_id, text, text AS t8, {stale('text')} AS st, {comps_joined('text', '; ')} AS cj,
         {any_comp('text')} AS anyc FROM documents),
m AS (SELECT *, coalesce(text <> '' AND NOT contains(t8, 'zz'), false) AS has_v FROM d)
SELECT doc_id, CASE WHEN has_v THEN 'model' ELSE 'fallback' END AS verdict_source,
       CASE WHEN has_v THEN 'Scored ' || CAST(length(t8) AS VARCHAR) || ' chars.'
            ELSE {narrative('st', 'text', R.stale_note_web)} END AS says_about_brand,
       CASE WHEN has_v THEN contains(lower(t8), 'there') ELSE anyc END AS mentions_competition,
       CASE WHEN has_v THEN (CASE WHEN contains(lower(t8), 'there') THEN 'There' ELSE '' END) ELSE cj END
         AS competitors_named,
       CAST(CASE WHEN has_v THEN 0.5 ELSE 0.0 END AS DOUBLE) AS sentiment
FROM m"""
    q.update(landing_oracles())
    u = f"""(CASE WHEN page_id % 5 = 0 THEN ' https://Apps.Apple.com/us/app/reader/id' || CAST(page_id AS VARCHAR) || '?mt=8'
             WHEN page_id % 5 = 1 THEN 'https://play.google.com/store/apps/details?id=net.example.r'
                                       || CASE WHEN page_id % 2 = 0 THEN 'eader' ELSE CAST(page_id AS VARCHAR) END
             WHEN page_id % 10 = 2 THEN 'https://www.amazon.com/x/dp/B' || CAST(page_id AS VARCHAR)
             WHEN page_id % 10 = 7 THEN 'https://www.amazon.com/s?k=/dp' || CAST(page_id AS VARCHAR) ELSE url END)"""
    q["ownership_branches"] = f"""WITH a AS (SELECT page_id, {strip(u)} AS u FROM pages)
SELECT page_id, u AS url, {ownership('u', host('u'))} AS ownership FROM a"""
    q["topics_catalog"] = """SELECT 't' || CAST(p_partkey AS VARCHAR) AS id, p_type AS intent, p_name AS query FROM part WHERE p_size % 7 <> 0"""
    q["merged_bodies"] = f"""WITH {cte_cache().strip()}, {req}, {cte_crawled().strip()},
hits AS (SELECT r.url, f.text FROM req r JOIN fresh f ON f.url = r.url)
SELECT coalesce(h.url, c.url) AS url, coalesce(c.text, h.text) AS text FROM hits h FULL OUTER JOIN crawled_all c ON c.url = h.url"""
    q["web_csv"] = f"{web} SELECT {WEB_COLS} FROM w_sheet"
    q["answers_csv"] = f"{ans} SELECT {cols_text} FROM asheet"
    q["run_written"] = f"""{web}
SELECT k AS key, v AS value FROM (
  SELECT unnest(['count.rows', 'count.source_web', 'count.source_news', 'count.source_reddit', 'count.nonprod', 'count.fetch_cache', 'empty_written']) AS k,
         unnest([CAST(n AS VARCHAR), CAST(w AS VARCHAR), CAST(nw AS VARCHAR), CAST(rd AS VARCHAR), CAST(np AS VARCHAR), CAST(fc AS VARCHAR), 'false']) AS v
  FROM (SELECT count(*) AS n, count_if(source = 'web') AS w, count_if(source = 'news') AS nw, count_if(source = 'reddit') AS rd,
               count_if(nonprod_url) AS np, count_if(fetch_status = 'cache') AS fc FROM w_sheet))"""
    q["repeated_verdicts"] = f"""WITH v AS (
  SELECT doc_id % 50 AS key, doc_id, quality, row_number() OVER (PARTITION BY doc_id % 50 ORDER BY doc_id DESC) AS rn FROM labels)
SELECT d.doc_id, CASE WHEN v.key IS NOT NULL THEN 'model' ELSE 'fallback' END AS verdict_source,
       CASE WHEN v.key IS NOT NULL THEN CASE WHEN v.quality = 1 THEN 'Good page.' ELSE 'Weak page.' END
            ELSE {narrative(stale('d.text'), 'd.text', R.stale_note_web)} END AS says_about_brand
FROM documents d LEFT JOIN (SELECT * FROM v WHERE rn = 1) v ON v.key = d.doc_id % 100"""
    run_cols = ("status", "mentioned", "competitors_named", "sentiment", "sources_cited", "response_text")
    one_col = " ".join(f"""LEFT JOIN (SELECT prompt, bool_or(d <> 0) AS differs FROM (SELECT prompt, {c}, sum(nb - na) AS d FROM r GROUP BY prompt, {c}) GROUP BY prompt) c{i}
       ON c{i}.prompt IS NOT DISTINCT FROM k.prompt""" for i, c in enumerate(run_cols))
    differing = ", ".join(f"CASE WHEN c{i}.differs THEN {lit(c)} END" for i, c in enumerate(run_cols))
    q["answer_runs_diff"] = f"""{ans},
r AS (SELECT prompt, {", ".join(run_cols)}, count_if(surface = 'chatgpt') AS na, count_if(surface = 'perplexity') AS nb
      FROM asheet WHERE surface IN ('chatgpt', 'perplexity') GROUP BY ALL),
k AS (SELECT prompt, CAST(sum(na) AS BIGINT) AS rows_before, CAST(sum(nb) AS BIGINT) AS rows_after, CAST(sum(least(na, nb)) AS BIGINT) AS rows_same FROM r GROUP BY prompt),
c AS (SELECT *, CASE WHEN rows_before = 0 THEN 'added' WHEN rows_after = 0 THEN 'removed'
                     WHEN rows_same = rows_before AND rows_before = rows_after THEN 'same' ELSE 'changed' END AS change FROM k)
SELECT k.prompt, k.change, CASE WHEN k.change = 'changed' THEN concat_ws(',', {differing}) ELSE '' END AS changed_columns, k.rows_before, k.rows_after, k.rows_same
FROM c k {one_col}"""
    q["catalog_select_table"] = """WITH c AS (SELECT p_partkey + 1 AS pos, p_name AS label FROM part),
t AS (SELECT s_suppkey AS ord, CASE WHEN s_suppkey % 3 = 0 THEN CAST(s_suppkey * 7 AS VARCHAR) ELSE trim(upper(substr(p_name, 3, 4 + s_suppkey % 9))) END AS token,
             s_suppkey % 3 = 0 AS number FROM supplier JOIN part ON s_suppkey = p_partkey),
m AS (SELECT c.pos, c.label, min(t.ord) AS sel_ord FROM c JOIN t ON t.token <> '' AND CASE WHEN number THEN CAST(c.pos AS VARCHAR) = token
      ELSE contains(lower(c.label), lower(token)) END GROUP BY c.pos, c.label),
r AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY sel_ord, pos) AS rn FROM m)
SELECT label, CAST(sel_ord AS BIGINT) AS sel_ord, pos FROM r WHERE rn = 1"""
    prefixes = ", ".join(lit(x) for x in R.nonprod_prefixes)
    q["ownership_domain_table"] = f"""WITH u AS (
  SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN 'm.c' WHEN 1 THEN 'blog.www.c' ELSE 'c' END || CAST(c_custkey AS VARCHAR) || '.n' || CAST(c_nationkey AS VARCHAR) || '.shop.test' AS host FROM customer),
rival AS (SELECT 'c' || CAST(s_suppkey AS VARCHAR) || '.n' || CAST(s_nationkey AS VARCHAR) || '.shop.test' AS d FROM supplier),
own AS (SELECT 'n' || CAST(n_nationkey AS VARCHAR) || '.shop.test' AS d FROM nation WHERE n_regionkey < 3)
SELECT c_custkey, host, CASE WHEN EXISTS (SELECT 1 FROM rival WHERE host = d OR ends_with(host, '.' || d)) THEN 'competitor'
                             WHEN EXISTS (SELECT 1 FROM own WHERE host = d OR ends_with(host, '.' || d)) THEN 'owned' ELSE 'third_party' END AS ownership,
       EXISTS (SELECT 1 FROM own WHERE ends_with(host, '.' || d)) AND split_part(host, '.', 1) IN ({prefixes}) AS nonprod_url FROM u"""
    catalog = """cat AS (SELECT array_to_string(string_split(text, ' ')[1:2], ' ') AS brand, CAST(min(conv_id * 1000 + turn) AS BIGINT) AS brand_pos
             FROM conversations GROUP BY 1)"""
    q["catalog_mentions"] = f"""WITH {catalog} SELECT d.doc_id, brand_pos, brand FROM documents d JOIN cat ON contains(lower(d.text), lower(brand))"""
    w = r"[\pL\pN_]"
    word = (f"regexp_matches(lower(d.text), CASE WHEN regexp_matches(brand, '^{w}') THEN '(^|[^\\pL\\pN_])' ELSE '{w}' END || regexp_escape(lower(brand)) "
            f"|| CASE WHEN regexp_matches(brand, '{w}$') THEN '([^\\pL\\pN_]|$)' ELSE '{w}' END)")
    q["catalog_brands"] = f"""WITH {catalog},
near AS MATERIALIZED (SELECT d.doc_id, d.text, brand_pos, brand FROM documents d JOIN cat ON contains(lower(d.text), lower(brand))),
hit AS (SELECT doc_id, brand_pos, brand FROM near d WHERE {word}),
l AS (SELECT doc_id, string_agg(brand, '; ' ORDER BY brand_pos) AS names, count(*) AS n FROM hit GROUP BY doc_id)
SELECT d.doc_id, coalesce(names, '') AS competitors_named, coalesce(n, 0) AS n_brands FROM documents d LEFT JOIN l ON l.doc_id = d.doc_id"""
    votes = {"yes": "{x}", "no": "NOT {x}", "none": "{x} IS NULL"}
    def nine(f):
        return ", ".join(f"CAST(count_if(({votes[x].format(x='g_' + f)}) AND ({votes[y].format(x='p_' + f)})) AS BIGINT) AS {x}_{y}" for x in votes for y in votes)
    def flag_row(f, name):
        return f"""SELECT {lit(name)} AS field, {", ".join(f"{x}_{y}" for x in votes for y in votes)}, rated, round(agree, 6) AS accuracy,
  round(CASE WHEN chance < 1 THEN (agree - chance) / (1 - chance) END, 6) AS kappa, round(rated / nullif(rated + yes_none + no_none, 0), 6) AS coverage,
  CAST(NULL AS DOUBLE) AS mae, CAST(NULL AS DOUBLE) AS bias
FROM (SELECT *, gy * py + (1 - gy) * (1 - py) AS chance FROM (SELECT *, (yes_yes + no_no) / nullif(rated, 0) AS agree, (yes_yes + yes_no) / nullif(rated, 0) AS gy,
  (yes_yes + no_yes) / nullif(rated, 0) AS py FROM (SELECT *, yes_yes + yes_no + no_yes + no_no AS rated FROM (SELECT {nine(f)} FROM j))))"""
    prices = "len(list_distinct(regexp_extract_all(d.text, '\\$\\s?\\d{2,}')))"
    q["gold_agreement"] = f"""WITH j0 AS (
  SELECT {any_comp('d.text')} AS p_mc, {mentions('d.text')} AS own, {prices} AS n, l.toxic = 1 AS g_mc, l.quality = 1 AS g_mb, l.quality AS g_rank
  FROM labels l LEFT JOIN documents d ON l.doc_id = d.doc_id),
j AS (SELECT *, CASE WHEN NOT p_mc THEN own END AS p_mb, CASE WHEN own THEN n END AS p_rank FROM j0)
{flag_row('mc', 'mentions_competition')} UNION ALL {flag_row('mb', 'mentions_brand')}
UNION ALL SELECT 'rank', {", ".join(["CAST(0 AS BIGINT)"] * 9)}, count(p_rank - g_rank), NULL, NULL, round(count(p_rank - g_rank) / nullif(count(g_rank), 0), 6),
  round(avg(abs(CAST(p_rank AS DOUBLE) - g_rank)), 6), round(avg(CAST(p_rank AS DOUBLE) - g_rank), 6) FROM j"""
    scored = """t AS (SELECT 'd' || CAST(doc_id AS VARCHAR) AS key, text FROM documents
      UNION ALL SELECT concat_ws('-', 'c', CAST(conv_id AS VARCHAR), CAST(turn AS VARCHAR)), text FROM conversations),
v AS (SELECT *, NOT contains(text, 'zz') AS ok, contains(lower(text), 'there') AS there FROM t)"""
    q["ledger_verdicts"] = f"""WITH {scored} SELECT key, CASE WHEN ok THEN 'ok' ELSE 'failed' END AS score_status,
       CASE WHEN ok THEN 'Scored ' || CAST(length(text) AS VARCHAR) || ' chars.' END AS says_about_brand,
       CASE WHEN ok THEN there END AS mentions_competition, CAST(CASE WHEN ok THEN 0.5 END AS DOUBLE) AS sentiment FROM v"""
    q["ledger_entries"] = f"""WITH {scored} SELECT CASE WHEN ok THEN 'ok' ELSE 'failed' END AS score_status,
       count(DISTINCT text) AS entries, count(DISTINCT text) AS texts FROM v GROUP BY 1"""
    web_counts = ", ".join(f"CAST(count_if(source = {lit(x)}) AS BIGINT) AS source_{x}" for x in
                           ("web", "ai_overview", "chatgpt_search", "perplexity_search", "news", "ads", "reddit"))
    web_counts += ", CAST(0 AS BIGINT) AS source_other"
    q["run_counters"] = f"""{web}
SELECT CAST(count(*) AS BIGINT) AS rows, {web_counts}, CAST(count(DISTINCT url) AS BIGINT) AS unique_urls,
       CAST(count_if(nonprod_url) AS BIGINT) AS nonprod,
       CAST(count_if(verdict_source = 'fallback') AS BIGINT) AS fallback_verdicts,
       CAST(count_if(fetch_status = 'cache') AS BIGINT) AS fetch_cache, CAST(count_if(fetch_status = 'crawl') AS BIGINT) AS fetch_crawl,
       CAST(count_if(fetch_status = 'missing') AS BIGINT) AS fetch_missing
FROM w_sheet"""
    q["competitor_share"] = f"""{ans},
ok AS (SELECT * FROM asheet WHERE status = 'ok'),
tot AS (SELECT surface, CAST(count(*) AS BIGINT) AS ok_answers FROM ok GROUP BY surface),
named AS (SELECT surface, brand, CAST(count(*) AS BIGINT) AS answers FROM (
            SELECT surface, unnest(list_distinct(string_split(competitors_named, '; '))) AS brand FROM ok)
          WHERE brand <> '' GROUP BY surface, brand)
SELECT n.surface, n.brand, n.answers, t.ok_answers, round(n.answers / t.ok_answers, 4) AS share
FROM named n JOIN tot t ON t.surface = n.surface"""
    q["nonprod_cited"] = f"""{ans}
SELECT DISTINCT src AS url FROM (SELECT unnest(string_split(sources_cited, ', ')) AS src FROM asheet)
WHERE src <> '' AND {nonprod(host('src'))}"""
    return q


def page_base_cte() -> str:
    return f"""
pb AS (
  SELECT d.doc_id AS page_id, p.url, p.html, d.text AS doc, c.turns, n.url AS next_url,
         regexp_extract(p.html, '<title>(.*?)</title>', 1) AS title,
         regexp_extract(p.url, '^https?://[^/]+/([a-z]{{2}})/', 1) AS lang
  FROM documents d
  JOIN pages p ON p.page_id = d.doc_id % {N_PAGES}
  JOIN pages n ON n.page_id = (d.doc_id + 1) % {N_PAGES}
  LEFT JOIN (SELECT conv_id, list(text ORDER BY turn) AS turns FROM conversations GROUP BY conv_id) c ON c.conv_id = d.doc_id)"""


def serp_ctes(platform: str, overviews: bool) -> str:
    """Records of the landed search items as CTE ``r`` (over ``pb``, with query ``q``)."""
    q = "CASE WHEN page_id % 10 = 4 THEN '' ELSE lang END"
    rows = f"""
SELECT url, '{platform}' AS platform, q AS query, CAST(1 AS BIGINT) AS rank, coalesce(title, '') AS title,
       coalesce(doc, '') AS snippet, page_id AS item, 0 AS kind, 0 AS pos FROM pq WHERE coalesce(url, '') <> ''
UNION ALL
SELECT next_url, '{platform}', q, CAST(3 AS BIGINT), 'next', '', page_id, 0, 2 FROM pq WHERE coalesce(next_url, '') <> ''"""
    if overviews:
        ai = ("(CASE WHEN page_id % 3 = 0 THEN '{\"n\":' || CAST(page_id AS VARCHAR) || '}' "
              "WHEN page_id % 3 = 1 THEN '[1] ' || title ELSE nullif(coalesce(doc, ''), '') END)")
        rows += f"""
UNION ALL
SELECT 'aioverview::' || q, 'ai_overview', q, CAST(0 AS BIGINT), 'Google AI Overview', ai, page_id, 1, 0
FROM (SELECT *, {ai} AS ai FROM pq) WHERE ai IS NOT NULL
UNION ALL
SELECT 'chatgptsearch::' || q, 'chatgpt_search', q, CAST(0 AS BIGINT), 'ChatGPT Search Panel', t, page_id, 2, i - 1
FROM (SELECT q, page_id, unnest(turns) AS t, CAST(unnest(generate_series(1, len(turns))) AS INTEGER) AS i FROM pq WHERE turns IS NOT NULL)
WHERE coalesce(t, '') <> ''
UNION ALL
SELECT 'perplexitysearch::' || q, 'perplexity_search', q, CAST(0 AS BIGINT), 'Perplexity Search Panel',
       'px ' || title, page_id, 3, 0 FROM pq WHERE page_id % 2 = 0"""
    topics = ", ".join(f"({lit(t['id'])}, {lit(t['intent'])}, {lit(t['query'])}, {i})" for i, t in enumerate(tb.LANG_TOPICS))
    return f"""
lt AS (
  SELECT id, intent, query FROM (
    SELECT *, row_number() OVER (PARTITION BY query ORDER BY seq DESC) AS rn
    FROM (VALUES {topics}) t(id, intent, query, seq)) WHERE rn = 1),
pq AS (SELECT *, {q} AS q FROM pb),
r0 AS ({rows}),
r AS (SELECT r0.* EXCLUDE (kind, pos), coalesce(lt.intent, 'unknown') AS intent, coalesce(lt.id, '') AS topic_id,
             CAST(kind AS INTEGER) AS kind, CAST(pos AS INTEGER) AS pos FROM r0 LEFT JOIN lt ON lt.query = r0.query)"""


def ads_sql() -> str:
    """Landed ads over ``pb``: url, title, snippet, advertiser, ownership, item."""
    adv = ("(CASE WHEN page_id % 4 = 0 THEN 'License Corp' WHEN page_id % 4 = 1 THEN 'Example Ads' "
           "WHEN page_id % 4 = 2 THEN 'AR' || CAST(page_id AS VARCHAR) ELSE 'Shop ' || CAST(page_id AS VARCHAR) END)")
    raw = ("(CASE WHEN page_id % 3 = 0 AND coalesce(url, '') <> '' THEN url "
           "WHEN page_id % 6 = 1 AND coalesce(next_url, '') <> '' THEN next_url ELSE '' END)")
    copy = "(CASE WHEN page_id % 7 = 0 THEN '' ELSE concat_ws(' ', nullif(title, ''), nullif(coalesce(doc, ''), '')) END)"
    comp_tokens = [d.split(".")[-2] if "." in d else d for d in R.competitor_domains]
    comp = " OR ".join(f"contains(lower(adv), {lit(t.lower())})" for t in comp_tokens) or "false"
    return f"""
SELECT CASE WHEN raw_url <> '' THEN raw_url ELSE 'ad::' || creative END AS url, adv AS title, cp AS snippet, adv AS advertiser,
       CASE WHEN contains(lower(adv), {lit(R.brand_lower)}) THEN 'owned' WHEN {comp} THEN 'competitor'
            ELSE {ownership('raw_url', host('raw_url'))} END AS ownership, page_id AS item
FROM (SELECT page_id, {adv} AS adv, {raw} AS raw_url, {copy} AS cp,
             CASE WHEN page_id % 5 = 0 THEN {adv} ELSE 'CR' || CAST(page_id AS VARCHAR) END AS creative FROM pb)
WHERE raw_url <> '' OR cp <> ''"""


def forum_sql() -> str:
    return f"""
SELECT u AS url, 'Thread ' || CAST(conv_id AS VARCHAR) AS title, coalesce(text, '') AS snippet, conv_id * 1000 + turn AS item
FROM (
  SELECT c.conv_id, c.turn, c.text,
         coalesce(nullif(CASE WHEN c.conv_id % 2 = 0 THEN p.url END, ''),
                  CASE WHEN c.role <> 'system' THEN 'https://forum.test/p/' || CAST(c.conv_id AS VARCHAR) || '/'
                       || CAST(c.turn AS VARCHAR) END) AS u
  FROM conversations c JOIN pages p ON p.page_id = c.conv_id % {N_PAGES})
WHERE u IS NOT NULL"""


def landing_oracles() -> dict[str, str]:
    q: dict[str, str] = {}
    pb = page_base_cte().strip()
    cols = "url, platform, query, intent, topic_id, rank, title, snippet"
    q["serp_records"] = f"WITH {pb}, {serp_ctes('web', True).strip()} SELECT {cols}, item, kind, pos FROM r"
    q["news_records"] = f"WITH {pb}, {serp_ctes('news', False).strip()} SELECT {cols}, item, kind, pos FROM r"
    q["ad_records"] = f"WITH {pb} {ads_sql()}"
    q["forum_records"] = forum_sql()
    news = serp_ctes("news", False).strip().replace("lt AS", "nlt AS").replace("JOIN lt ", "JOIN nlt ").replace("lt.", "nlt.") \
        .replace("pq AS", "npq AS").replace("FROM pq", "FROM npq").replace("r0", "n0").replace("r AS", "nr AS")
    q["landed_discovery"] = f"""WITH {pb}, {serp_ctes('web', True).strip()}, {news}
SELECT {cols}, CAST(NULL AS VARCHAR) AS ownership, CAST(0 AS BIGINT) AS source_ord, kind, pos FROM r
UNION ALL SELECT {cols}, NULL, 1, kind, pos FROM nr
UNION ALL SELECT url, 'ads', 'ads', 'ads', '', 0, title, snippet, ownership, 2, 0, 0 FROM ({ads_sql()})
UNION ALL SELECT url, 'reddit', 'reddit', 'community', '', 0, title, snippet, NULL, 3, 0, 0 FROM ({forum_sql()})"""
    body = "coalesce(CASE WHEN page_id % 2 = 0 THEN nullif(doc, '') END, nullif(html, ''), '')"
    q["page_bodies"] = f"""WITH {pb},
b AS (SELECT {canon('url')} AS url, {body} AS text, page_id FROM pb)
SELECT url, text FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY page_id DESC) AS rn FROM b)
WHERE rn = 1"""
    q["landed_pages"] = f"""WITH {pb}
SELECT 'https://crawl.test/' || CAST(page_id AS VARCHAR) AS url, {body} AS text FROM pb"""
    items = """SELECT surface, run, prompt, coalesce(response, '') AS response,
       array_to_string(list_filter(citations, lambda u: u IS NOT NULL AND u <> ''), ', ') AS citations"""
    q["answer_items"] = f"""WITH {cte_answers().strip()}
{items}, conv_id * 1000 + turn AS item FROM ans WHERE coalesce(prompt, '') <> ''"""
    api = items.replace("SELECT surface", "SELECT 'perplexity' AS surface")
    q["answer_api_items"] = f"WITH {cte_answers().strip()} {api}, conv_id * 1000 + turn AS item FROM ans"
    q["landed_answers"] = f"""WITH {cte_answers().strip()}
{items} FROM ans WHERE coalesce(prompt, '') <> ''
UNION ALL {api} FROM ans"""
    return q
