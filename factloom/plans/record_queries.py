"""Queries that run the extraction, resolution, verification and state operators over the supplied tables in their roles.

Their SQL states each rule on its own; inputs are texts and claims that the tables' columns decide.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import figures, geo, text, urls
from ..operators import checks, consolidate, enrich, extract, links, progress, resolve, review, robots
from .tables import table

Q, S = {}, {}


def query(name, sql=None):
    def keep(f):
        Q[name], S[name] = f, sql
        return f

    return keep


def said(*parts):
    return F.concat(*[p.cast("string") if not isinstance(p, str) else F.lit(p) for p in parts])


def choose(by, *options):
    """One of the options by a number modulo their count."""
    out = options[-1] if not isinstance(options[-1], str) else F.lit(options[-1])
    for k, o in reversed(list(enumerate(options[:-1]))):
        out = F.when(by % len(options) == k, o if not isinstance(o, str) else F.lit(o)).otherwise(out)
    return out


# ---------------------------------------------------------------- extraction


@query("headcount_in_text", """SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN p_size WHEN 1 THEN p_size * 1000 + 234 WHEN 2 THEN NULL WHEN 3 THEN p_size WHEN 4 THEN NULL ELSE p_size END AS value,
  CASE p_partkey % 6 WHEN 2 THEN NULL WHEN 4 THEN NULL WHEN 3 THEN false ELSE true END AS strong, CASE p_partkey % 6 WHEN 2 THEN NULL WHEN 4 THEN NULL WHEN 5 THEN true ELSE false END AS approx FROM part""")
def _(spark, d):
    n = F.col("p_size")
    body = choose(
        F.col("p_partkey"), said("会社概要 | 従業員数 | ", n, "名 | 設立"), said("社員数：", n, ",234人（2024年4月現在）"), said("従業員数 ", n + 2000, "年"), said("社員 1. 募集 | 従業員: ", n, "人"), said("従業員 ", n), said("従業員数(連結) ", n, "〜", n + 50, "名"))
    got = table(spark, d, "part").select("p_partkey", figures.headcount(body).alias("h"))
    return got.select("p_partkey", F.col("h.value").alias("value"), F.col("h.strong").alias("strong"), F.col("h.approx").alias("approx"))


@query("address_in_text", """SELECT s_suppkey, CASE s_suppkey % 4 WHEN 0 THEN '東京都港区' || s_nationkey || '-1' WHEN 1 THEN '大阪府大阪市北区' || s_nationkey WHEN 2 THEN '神奈川県横浜市' || s_nationkey END AS address,
  CASE s_suppkey % 4 WHEN 3 THEN NULL WHEN 2 THEN false ELSE true END AS labeled, CASE s_suppkey % 4 WHEN 0 THEN true WHEN 3 THEN NULL ELSE false END AS tokyo,
  CASE s_suppkey % 4 WHEN 0 THEN '港区' WHEN 1 THEN '大阪市' WHEN 2 THEN '横浜市' END AS city FROM supplier""")
def _(spark, d):
    n = F.col("s_nationkey")
    body = choose(F.col("s_suppkey"), said("案内 | 本社所在地 | 〒100-0001 東京都港区", n, "-1 TEL 03 | x"), said("所在地：大阪府大阪市北区", n, " | 東京都"), said("x | 〒220-0001 神奈川県横浜市", n, " 地図"), said("東京都港区", n))
    rows = table(spark, d, "supplier").select("s_suppkey", geo.address(body).alias("a"))
    a = F.col("a.address")
    return rows.select("s_suppkey", a.alias("address"), F.col("a.labeled").alias("labeled"), F.when(a.isNotNull(), geo.in_tokyo(a)).alias("tokyo"), geo.city(a).alias("city"))


_PATH = "coalesce(nullif(regexp_extract(url, '^[a-z]+://[^/?#]+([^?#]*)', 1), ''), '/')"


def _sql_list(words):
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


def _kind_sql(path):
    """The purpose of a path by its segments and words; the order of the kinds is that of the table."""
    parts, cases = f"string_split(lower({path}), '/')", []
    for kind, places, words in links.KINDS:
        holds = []
        if places:
            holds.append(f"list_has_any({parts}, {_sql_list(places)})")
        if words:
            holds.append(f"len(list_filter({_sql_list(words)}, lambda w: contains(lower({path}), w))) > 0")
        if kind == links.ENGLISH:
            holds.append(f"len(list_filter({parts}, lambda s: right(s, 3) IN ('-en', '_en') OR contains(s, '-en.') OR contains(s, '_en.'))) > 0")
        if kind == links.SEPARATE:
            holds.append(f"list_contains({parts}[2:], 'entry')")
        cases.append(f"WHEN {' OR '.join(holds)} THEN '{kind}'")
    return f"CASE {' '.join(cases)} END"


@query("contact_kind_case", f"""WITH u AS (SELECT page_id, {_PATH} || CASE page_id % 7 WHEN 0 THEN '/ir/' WHEN 1 THEN '/recruit' WHEN 2 THEN '/faq/' WHEN 3 THEN '/service/x' WHEN 4 THEN '/contact' WHEN 5 THEN '/press/' ELSE '/privacy' END || ' ' AS p FROM pages)
SELECT page_id, {_kind_sql('p')} AS kind FROM u""")
def _(spark, d):
    tail = choose(F.col("page_id"), "/ir/", "/recruit", "/faq/", "/service/x", "/contact", "/press/", "/privacy")
    bare = F.regexp_replace("url", "[?#].*$", "")
    return table(spark, d, "pages").select("page_id", links.contact_kind(F.concat(bare, tail), F.lit("")).alias("kind"))


@query("contact_links_ranked", """WITH a AS (SELECT page_id, 'https://own.jp/' AS base, unnest([{'i': 0, 'p': '/contact/', 't': 'お問い合わせ', 'own': page_id % 2 = 0}, {'i': 1, 'p': '/support', 't': 'x', 'own': true}, {'i': 2, 'p': '/ir/contact', 't': 'IRお問い合わせ', 'own': true}, {'i': 3, 'p': '/form-' || page_id % 3, 't': 'フォーム', 'own': true}]) AS l FROM pages),
s AS (SELECT page_id, l.i, l.own, l.p, CASE l.i WHEN 0 THEN 3 + 2 + 2 + 2 WHEN 1 THEN 2 WHEN 2 THEN 3 + 2 + 2 - 6 ELSE 2 END + l.own::INT AS score FROM a)
SELECT page_id, CASE WHEN own THEN 'https://own.jp' ELSE 'https://other.jp' END || p AS url, CAST(score AS INTEGER) AS score, CAST(row_number() OVER (PARTITION BY page_id ORDER BY score DESC, i) AS INTEGER) AS place FROM s""")
def _(spark, d):
    link = lambda href, label: F.struct(href.alias("href"), F.lit(label).alias("text"))
    own = F.when(F.col("page_id") % 2 == 0, "https://own.jp").otherwise("https://other.jp")
    anchors = F.array(link(F.concat(own, F.lit("/contact/")), "お問い合わせ"), link(F.lit("https://own.jp/support"), "x"), link(F.lit("https://own.jp/ir/contact"), "IRお問い合わせ"), link(said("https://own.jp/form-", F.col("page_id") % 3), "フォーム"))
    rows = table(spark, d, "pages").select("page_id", F.posexplode(links.contact_links(anchors, F.lit("https://own.jp/"))).alias("at", "l"))
    return rows.select("page_id", F.col("l.url").alias("url"), F.col("l.score").alias("score"), (F.col("at") + 1).alias("place"))


@query("contact_page_checks", """SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN true WHEN 1 THEN false WHEN 2 THEN true ELSE false END AS linked, CASE doc_id % 4 WHEN 0 THEN true ELSE false END AS guessed FROM documents WHERE length(trim(text)) > 0""")
def _(spark, d):
    rows = table(spark, d, "documents").where("length(trim(text)) > 0")
    body = choose(F.col("doc_id"), "お名前\nメールアドレス", F.col("text"), "窓口のご案内", said(F.col("text"), "\n"))
    u = F.lit("https://a.jp/contact/")
    look = lambda guess: links.contact_page(body, F.col("text"), guess, u, u)
    return rows.select("doc_id", look(False).alias("linked"), look(True).alias("guessed"))


# ---------------------------------------------------------------- claims


def claims(spark, d) -> DataFrame:
    """events as claims of headcounts: five sources, some undated, values a third of which are far apart."""
    e = table(spark, d, "events")
    source = F.create_map(*[F.lit(x) for pair in _SOURCES.items() for x in pair])[F.col("event_type")]
    snippet = F.when(F.col("event_id") % 4 == 0, said("20", (F.col("event_id") % 9 + 16), "年現在")).when(F.col("event_id") % 7 == 0, "グループ全体").otherwise("")
    return e.select(F.col("user_id").cast("string").alias("entity_key"), F.col("event_id").alias("seq"), F.lit("employees").alias("field"), (F.floor("value") + 1).cast("string").alias("value"), source.alias("source"), F.lit("u").alias("url"), snippet.alias("snippet"))


_SOURCES = {"signup": "wantedly", "purchase": "mynavi", "error": "salesnow", "view": "green", "click": "grip"}
_CLAIMS = """c AS (SELECT CAST(user_id AS VARCHAR) AS entity_key, event_id AS seq, CAST(floor(value) AS BIGINT) + 1 AS n, CASE event_type WHEN 'signup' THEN 'wantedly' WHEN 'purchase' THEN 'mynavi' WHEN 'error' THEN 'salesnow' WHEN 'view' THEN 'green' ELSE 'grip' END AS source,
  CASE WHEN event_id % 4 = 0 THEN 2000 + event_id % 9 + 16 END AS year, event_id % 4 <> 0 AND event_id % 7 = 0 AS wide FROM events),
k AS (SELECT *, CASE source WHEN 'green' THEN 3 WHEN 'grip' THEN 4 WHEN 'mynavi' THEN 5 WHEN 'salesnow' THEN 10 ELSE 14 END AS rk, coalesce(year * 12 + 6, -1) AS as_of FROM c),
p AS (SELECT * FROM k QUALIFY row_number() OVER (PARTITION BY entity_key ORDER BY as_of DESC, rk, seq) = 1)"""


@query("headcount_adopted", f"""WITH {_CLAIMS} SELECT p.entity_key, p.n AS employees, p.source AS employees_source, CASE WHEN year IS NOT NULL THEN year || '年' END AS as_of,
  CASE WHEN p.source = 'salesnow' AND p.n BETWEEN 10 AND 40 THEN NULL ELSE p.n >= 20 END AS emp20 FROM p""")
def _(spark, d):
    ev = claims(spark, d)
    ents = ev.select(F.col("entity_key").alias("key")).distinct().select("key", F.col("key").alias("name"), F.array().cast("array<struct<source:string,url:string>>").alias("sources"))
    got = consolidate.consolidate(ents, ev)
    return got.select("entity_key", "employees", "employees_source", F.col("employees_as_of").alias("as_of"), "emp20")


@query("headcount_check", f"""WITH {_CLAIMS}, f AS (SELECT * FROM k QUALIFY row_number() OVER (PARTITION BY entity_key, source ORDER BY seq) = 1),
w AS (SELECT p.entity_key, greatest(p.n, f.n)::DOUBLE / least(p.n, f.n) AS ratio, f.wide AS wide, row_number() OVER (PARTITION BY p.entity_key ORDER BY greatest(p.n, f.n)::DOUBLE / least(p.n, f.n) DESC, f.seq) AS at FROM p JOIN f ON p.entity_key = f.entity_key AND f.source <> p.source)
SELECT p.entity_key, p.source, CASE WHEN w.ratio >= 3 AND NOT w.wide AND NOT p.wide AND p.year IS NULL THEN 'NG' ELSE 'OK' END AS result FROM p LEFT JOIN w ON w.entity_key = p.entity_key AND w.at = 1""")
def _(spark, d):
    ev = claims(spark, d)
    ents = ev.select(F.col("entity_key").alias("key")).distinct().select("key", F.col("key").alias("name"), F.array().cast("array<struct<source:string,url:string>>").alias("sources"))
    got = consolidate.consolidate(ents, ev).join(checks.gathered(ev), "entity_key")
    found = checks.employees(F.col("employees"), F.col("employees_source"), F.col("employees_snippet"), F.col("evidence"), 2026)
    return got.select("entity_key", F.col("employees_source").alias("source"), found["result"].alias("result"))


@query("official_url_adopted", """WITH e AS (SELECT page_id // 4 AS entity_key, page_id AS seq, url, CASE page_id % 5 WHEN 0 THEN 'human' WHEN 1 THEN 'boxil' WHEN 2 THEN 'salesnow' WHEN 3 THEN 'unknown' ELSE 'digimado' END AS source,
  CASE page_id % 5 WHEN 0 THEN 0 WHEN 1 THEN 7 WHEN 2 THEN 1 WHEN 3 THEN 99 ELSE 13 END AS rk, regexp_replace(regexp_extract(lower(url), '^[a-z]+://([^/?#:]+)', 1), '^www[.]', '') AS host FROM pages),
b AS (SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY entity_key ORDER BY rk, seq) = 1)
SELECT CAST(b.entity_key AS BIGINT) AS entity_key, b.url AS official_url, b.source AS official_source, (SELECT count(DISTINCT e.url) FROM e WHERE e.entity_key = b.entity_key AND e.host <> b.host) AS others,
  NOT EXISTS (SELECT 1 FROM e WHERE e.entity_key = b.entity_key AND e.source IN ('salesnow', 'boxil')) AS needs_corporate FROM b""")
def _(spark, d):
    source = choose(F.col("page_id"), "human", "boxil", "salesnow", "unknown", "digimado")
    ev = table(spark, d, "pages").select(F.floor(F.col("page_id") / 4).alias("entity_key"), F.col("page_id").alias("seq"), F.lit("officialUrl").alias("field"), F.col("url").alias("value"), source.alias("source"))
    gave = ev.groupBy("entity_key").agg(F.collect_set("source").alias("sources"))
    best = enrich.best_official(ev).join(gave, "entity_key")
    return best.select("entity_key", "official_url", "official_source", F.size("other_urls").cast("long").alias("others"), enrich.needs_corporate_url(F.col("sources")).alias("needs_corporate"))


# ---------------------------------------------------------------- checks


#: Words of the supplied texts in the place of the configured ones.
_CATEGORIES = {
    "first": {"main": ["thing", "heer", "anthe"], "extra": ["ingth", "hean", "ionth"], "extra_label": "extra", "weak": ["tion"]},
    "second": {"main": ["auxé", "leoi", "ementla", "Elle"], "weak": ["ement", "eau"]},
    "third": {"main": ["erstin", "nthe", "schein", "aciónes"], "weak": []},
}
_LABELS = {"first": "A", "second": "B", "third": "C"}
_OTHERS = ["sch", "ción", "%%%", "***", "ough"]
_GAP = r"[\s\x{00A0}\x{3000}]+"


def _industry_sql(key):
    core, label = _CATEGORIES[key], _LABELS[key]
    hits = lambda c, words: f"list_filter({_sql_list(words)}, lambda w: contains({c}, w))" if words else "[]"
    times = " + ".join(f"len(string_split(body, '{w}')) - 1" for w in core["main"])
    first = lambda c, words, n=3, mark="/": f"array_to_string({hits(c, words)}[1:{n}], '{mark}')"
    own, body, near, lacks = (f"len({hits(c, w)}) {t}" for c, w, t in (("own", core["main"], "> 0"), ("body", core["main"], "> 0"), ("body", core["weak"], "> 0"), ("body", core.get("extra", []), "= 0")))
    if not core.get("extra"):
        lacks = "false"
    aside = f"CASE WHEN len({hits('own', _OTHERS)}) > 0 THEN '（他に ' || {first('own', _OTHERS)} || ' 等の事業もあり、{label}は主業でない可能性）' ELSE '' END"
    often = f"({body} AND (len({hits('body', core['main'])}) >= 2 OR {times} >= 2))"
    return (
        f"CASE WHEN body = '' AND own = '' THEN 'check: 公式サイトの事業内容を確認できず、業種を判断できない' WHEN NOT {own} AND NOT {body} AND NOT {near} THEN 'NG: 公式サイトの文章に「{'/'.join(core['main'][:4])}」等が見当たらず、{label}とは確認できない' "
        f"WHEN ({own} OR {often}) AND {lacks} THEN 'check: {core.get('extra_label', '')}を示す記述が公式サイトに無く、{label}(の実態)は要確認' "
        f"WHEN {own} THEN 'OK: 公式の自社説明に「' || {first('own', core['main'])} || '」あり。{label}を取り扱っている' || {aside} "
        f"WHEN {often} THEN 'OK: 公式サイトの本文に「' || {first('body', core['main'])} || '」が複数あり、{label}を取り扱っている（自社説明の冒頭には無く、主業でない可能性）' || {aside} "
        f"WHEN {body} THEN 'check: 公式サイトの本文に「' || {first('body', core['main'], 1)} || '」の言及が1回あるのみで、取り扱いの実態は要確認' "
        f"ELSE 'check: 公式サイトに{label}を示す具体的な語がなく、関連語(' || {first('body', core['weak'])} || ')のみ。取り扱いの有無は要確認' END AS {key}")


@query("industry_checked", f"""WITH f AS (SELECT doc_id, array_to_string(list_filter(list_transform(regexp_split_to_array(coalesce(text, ''), '\n+'), lambda x: regexp_replace(x, '^{_GAP}|{_GAP}$', '', 'g')), lambda x: x <> ''), ' | ') AS flat FROM documents),
s AS (SELECT doc_id, regexp_replace(substr(flat, 1, 700), '{_GAP}', '', 'g') AS own, regexp_replace(flat, '{_GAP}', '', 'g') AS body FROM f)
SELECT doc_id, {_industry_sql('first')}, {_industry_sql('second')}, {_industry_sql('third')} FROM s""")
def _(spark, d):
    rule = checks.Industry(_CATEGORIES, _LABELS, _OTHERS)
    none = F.lit(None).cast("string")
    hits = text.once(checks.site_texts(none, none, F.col("text")), lambda s: F.struct(rule.hits(s["own"], s["body"]).alias("h"), ((s["own"] != "") | (s["body"] != "")).alias("seen")))
    rows = table(spark, d, "documents").select("doc_id", hits.alias("w"))
    said = lambda key: text.once(rule.check(key, F.col("w.h"), F.col("w.seen")), lambda o: F.concat(o["result"], F.lit(": "), o["comment"]))
    return rows.select("doc_id", *[said(key).alias(key) for key in _CATEGORIES])


_PLAIN = "regexp_replace(regexp_replace(html, '<(script|style)[^>]*>.*?</(script|style)>', ' ', 'gs'), '<[^>]*>', chr(10), 'g')"
_HOST = "regexp_extract(lower({0}), '^[a-z]+://([^/?#:]+)', 1)"
_SITE = "regexp_replace(" + _HOST + ", '^www[.]', '')"
_CORE = "string_split(" + _HOST + ", '.')[-2]"


def _own_sql(a, b):
    x, y = _SITE.format(a), _SITE.format(b)
    return f"({x} = {y} OR ends_with({x}, '.' || {y}) OR ends_with({y}, '.' || {x}) OR ({_CORE.format(a)} = {_CORE.format(b)} AND length({_CORE.format(a)}) >= 4))"


@query("contact_checked", f"""WITH p AS (SELECT page_id, url, length(html) AS n, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, {_PLAIN} AS text FROM pages),
m AS (SELECT p.page_id, p.n, p.url, p.title, o.url AS official, CASE WHEN p.n % 7 = 2 THEN p.url || '/moved' ELSE p.url END AS final, p.text || CASE WHEN p.page_id % 3 = 0 THEN chr(10) || 'Contact' ELSE '' END AS body, o.text AS top FROM p JOIN p o ON o.page_id = p.page_id - p.page_id % 3),
k AS (SELECT *, list_distinct(list_filter(list_transform(string_split(body, chr(10)), lambda x: trim(x)), lambda x: x <> '')) AS a, list_distinct(list_filter(list_transform(string_split(top, chr(10)), lambda x: trim(x)), lambda x: x <> '')) AS b,
  {_PATH.replace('(url', '(final')} AS final_path, {_SITE.format('final')} AS final_host FROM m),
j AS (SELECT *, coalesce({_kind_sql("final_path || ' '")}, {_kind_sql('title')}) AS kind, contains(lower(body), 'contact') AND NOT (len(a) > 0 AND len(b) > 0 AND len(list_intersect(a, b)) >= 0.8 * (len(a) + len(b) - len(list_intersect(a, b)))) AS looks FROM k)
SELECT page_id, CASE WHEN n % 7 = 1 THEN 'check' WHEN n % 7 = 0 THEN 'NG' WHEN NOT {_own_sql('url', 'official')} THEN 'NG' WHEN kind IS NOT NULL OR NOT looks THEN 'check'
  WHEN n % 7 = 2 THEN 'OK (redirect)' ELSE 'OK' END AS result, CASE WHEN n % 7 > 1 AND {_own_sql('url', 'official')} THEN kind END AS kind FROM j""")
def _(spark, d):
    plain = F.regexp_replace(F.regexp_replace("html", "(?s)<(script|style)[^>]*>.*?</(script|style)>", " "), "<[^>]*>", "\n")
    p = table(spark, d, "pages").select("page_id", "url", F.length("html").alias("n"), F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"), plain.alias("text"))
    top = p.select(F.col("page_id").alias("o_id"), F.col("url").alias("official"), F.col("text").alias("top"))
    met = p.join(top, F.col("page_id") - F.col("page_id") % 3 == F.col("o_id"))
    final = F.when(F.col("n") % 7 == 2, F.concat("url", F.lit("/moved"))).otherwise(F.col("url"))
    body = F.concat("text", F.when(F.col("page_id") % 3 == 0, "\nContact").otherwise(""))
    status = F.when(F.col("n") % 7 == 0, 404).when(F.col("n") % 7 == 1, 503).otherwise(200)
    page = F.struct(final.alias("final_url"), "title", body.alias("text"), F.lit(None).cast("string").alias("error"), status.alias("status"))
    found = checks.contact(F.col("url"), F.col("official"), F.col("official"), F.col("top"), page)
    got = met.select("page_id", found.alias("c"))
    kinds = F.regexp_extract("c.comment", "^(.+)の問い合わせページの可能性", 1)
    return got.select("page_id", F.col("c.result").alias("result"), F.nullif(kinds, F.lit("")).alias("kind"))


@query("identity_checked", """WITH m AS (SELECT c_custkey, c_custkey % 3 AS named, c_nationkey % 4 AS place, c_custkey % 5 AS site FROM customer)
SELECT c_custkey, CASE WHEN site = 4 THEN 'check' WHEN named = 0 AND place = 2 THEN 'NG' WHEN named = 0 AND place IN (1, 3) THEN 'check' WHEN named = 0 THEN 'check' WHEN place = 0 OR site = 3 THEN 'OK' ELSE 'check' END AS result FROM m""")
def _(spark, d):
    k, place = F.col("c_custkey"), F.col("c_nationkey") % 4
    official = F.when(k % 5 == 4, F.lit(None).cast("string")).otherwise("https://a.jp/")
    row = lambda field, value, source, keep: F.when(keep, F.struct(F.lit(0).cast("long").alias("seq"), F.lit(field).alias("field"), F.lit(value).alias("value"), F.lit(source).alias("source"), F.lit("u").alias("url"), F.lit("").alias("snippet")))
    ev = F.array_compact(F.array(
        row("address", "東京都港区1", "official", F.lit(True)), row("address", "東京都港区2", "green", place == 0), row("address", "大阪府大阪市", "grip", place == 2), row("address", "東京都千代田区", "mynavi", place == 3),
        row("officialUrl", "https://a.jp/", "boxil", F.lit(True)), row("officialUrl", "https://www.a.jp/x", "salesnow", k % 5 == 3)))
    site = F.when(k % 3 == 0, "別の会社").otherwise(said("株式会社name", k))
    found = checks.identity(said("name", k, "（略称）"), official, F.lit("東京都港区1"), site, F.lit(True), ev)
    return table(spark, d, "customer").select("c_custkey", found["result"].alias("result"))


@query("flat_checks_all_ok", """WITH m AS (SELECT doc_id, CASE toxic WHEN 1 THEN 'NG' ELSE CASE quality WHEN 1 THEN 'OK' ELSE 'check' END END AS a, CASE WHEN doc_id % 3 = 0 THEN 'check' ELSE 'OK' END AS b, CASE WHEN doc_id % 4 = 0 THEN 'OK' END AS human FROM labels)
SELECT doc_id, CASE WHEN 'NG' IN (a, b) THEN 'NG' WHEN 'check' IN (a, b) THEN 'check' ELSE 'OK' END AS worst, coalesce(CASE human WHEN 'OK' THEN 'OK (human)' END, a) AS first, coalesce(human, a) = 'OK' AS passes FROM m""")
def _(spark, d):
    a = F.when(F.col("toxic") == 1, "NG").when(F.col("quality") == 1, "OK").otherwise("check")
    b = F.when(F.col("doc_id") % 3 == 0, "check").otherwise("OK")
    good = checks.outcome("OK", "c")
    stored = F.struct(F.map_from_arrays(F.array(F.lit("sns_agency"), F.lit("ad_agency")), F.array(checks.outcome(a, "x"), checks.outcome(b, "y"))).alias("industry"), good.alias("employees"), checks.outcome("OK (redirect)", "z").alias("contact"), good.alias("identity"))
    none = F.lit(None).cast("string")
    review_ = F.struct(F.create_map(F.lit("sns_agency"), F.when(F.col("doc_id") % 4 == 0, "OK")).alias("industry"), none.alias("employees"), none.alias("contact"), none.alias("identity"), F.lit("d").alias("at"), none.alias("note"))
    rows = table(spark, d, "labels").select("doc_id", checks.flat(stored).alias("every"), checks.flat(stored, "sns_agency", review_).alias("one"))
    return rows.select("doc_id", F.col("every.industry.result").alias("worst"), F.col("one.industry.result").alias("first"), checks.all_ok(F.col("one")).alias("passes"))


# ---------------------------------------------------------------- resolution


_REGION = "CASE {k} % 3 WHEN 0 THEN '東京都港区' WHEN 1 THEN '大阪府大阪市' ELSE NULL END"


@query("registry_pick", f"""WITH s AS (SELECT s_suppkey, s_suppkey % 40 AS name, CASE WHEN s_suppkey % 2 = 0 THEN {_REGION.format(k='s_suppkey')} END AS known FROM supplier),
c AS (SELECT c_custkey, c_custkey % 400 AS name, {_REGION.format(k='c_nationkey')} AS address, CASE WHEN c_custkey % 4 > 0 THEN c_custkey END AS n, c_custkey % 11 = 0 AS closed FROM customer),
m AS (SELECT s_suppkey, known, c.*, count(*) OVER (PARTITION BY s_suppkey) AS same_name, max(coalesce(address LIKE '東京都%', false)::INT) OVER (PARTITION BY s_suppkey) AS any_tokyo FROM s JOIN c USING (name) WHERE NOT closed),
f AS (SELECT * FROM m WHERE CASE WHEN known IS NOT NULL THEN coalesce(address = known, false) ELSE coalesce(address LIKE '東京都%', false) OR same_name = 1 OR any_tokyo = 0 END)
SELECT s_suppkey, c_custkey, same_name FROM f QUALIFY row_number() OVER (PARTITION BY s_suppkey ORDER BY n IS NULL, c_custkey) = 1""")
def _(spark, d):
    region = lambda k: F.when(k % 3 == 0, "東京都港区").when(k % 3 == 1, "大阪府大阪市")
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("entity_key"), said("株式会社n", F.col("s_suppkey") % 40, "（旧）").alias("name"))
    known = table(spark, d, "supplier").where("s_suppkey % 2 = 0 AND s_suppkey % 3 < 2").select(F.col("s_suppkey").alias("entity_key"), F.array(region(F.col("s_suppkey"))).alias("addresses"))
    closed = F.when(F.col("c_custkey") % 11 == 0, " 閉鎖").otherwise("")
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("seq"), said("N", F.col("c_custkey") % 400, " (株)", closed).alias("name"), region(F.col("c_nationkey")).alias("address"), F.when(F.col("c_custkey") % 4 > 0, F.col("c_custkey")).alias("employees"))
    got = resolve.pick_registry(resolve.by_name(s, c), known)
    return got.select(F.col("entity_key").alias("s_suppkey"), F.col("seq").alias("c_custkey"), "same_name")


@query("merged_by_domain", """WITH p AS (SELECT page_id, page_id % 3 AS s, regexp_replace(regexp_extract(lower(url), '^[a-z]+://([^/?#:]+)', 1), '^www[.]', '') AS domain FROM pages),
f AS (SELECT *, first_value(page_id) OVER (PARTITION BY domain ORDER BY page_id) AS canonical FROM p)
SELECT canonical AS entity_key, min(domain) AS domain, count(*) AS seeds, count(DISTINCT s) AS sources, count(*) AS claims FROM f GROUP BY canonical""")
def _(spark, d):
    p = table(spark, d, "pages")
    ents = p.select(
        F.col("page_id").alias("entity_key"), F.col("url").alias("name"), F.col("page_id").alias("seq"), urls.domain(F.col("url")).alias("domain"),
        F.array(F.struct(F.lit("x").alias("source"), (F.col("page_id") % 3).cast("string").alias("url"))).alias("sources"), F.array(F.lit("k")).alias("seeds"))
    ev = p.select(F.col("page_id").alias("entity_key"), F.lit(0).cast("long").alias("seq"), F.lit("f").alias("field"))
    one, moved = resolve.merged_by_domain(ents, ev)
    per = moved.groupBy(F.col("entity_key").alias("_e")).agg(F.count("*").alias("claims"))
    return one.join(per, F.col("entity_key") == F.col("_e")).select("entity_key", "domain", F.size("seeds").cast("long").alias("seeds"), F.size("sources").cast("long").alias("sources"), "claims")


# ---------------------------------------------------------------- state


@query("progress_apply_run", """WITH o AS (SELECT o_custkey AS key, min(o_orderkey) AS a, count(*) AS n FROM orders GROUP BY o_custkey),
r AS (SELECT c_custkey AS key, c_custkey % 4 AS found, c_custkey % 3 = 0 AS bad, c_custkey % 2 = 0 AS paged FROM customer),
j AS (SELECT r.*, o.n, coalesce(CASE WHEN n % 2 = 0 THEN n + 1 ELSE 1 END, 1) AS next, coalesce(CASE WHEN n % 2 = 1 THEN n ELSE 0 END, 0) AS off, coalesce(n, 0) AS had FROM r LEFT JOIN o USING (key)),
x AS (SELECT *, found = 0 AND (bad OR (had = 0 AND next = 1 AND off = 0)) AS failed FROM j)
SELECT key, CAST(CASE WHEN found > 0 AND paged THEN 10 ELSE next END AS INTEGER) AS next_page, CAST(CASE WHEN found > 0 AND NOT paged THEN off + found ELSE off END AS INTEGER) AS start, CAST(had + found AS INTEGER) AS found,
  found = 0 AND NOT failed AS exhausted, CASE WHEN failed THEN 1 ELSE 0 END AS failures, CAST(CASE WHEN n IS NULL THEN 1 ELSE 2 END AS INTEGER) AS runs FROM x""")
def _(spark, d):
    n, t = F.col("n"), F.lit("2026-01-01 00:00:00").cast("timestamp")
    old = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("key")).agg(F.count("*").cast("int").alias("n")).select(
        "key", F.when(n % 2 == 0, n + 1).otherwise(1).alias("nextPage"), F.when(n % 2 == 1, n).otherwise(0).alias("offset"), n.alias("found"), F.lit(False).alias("exhausted"), F.lit(0).alias("failures"),
        F.lit(None).cast("string").alias("lastError"), F.lit(None).cast("timestamp").alias("failedAt"), F.lit(1).alias("runs"), t.alias("lastAt"))
    k = F.col("c_custkey")
    runs = table(spark, d, "customer").select(k.alias("key"), (k % 4).cast("int").alias("found"), F.when(k % 3 == 0, F.array(F.lit("! HTTP 500"))).otherwise(F.array().cast("array<string>")).alias("errors"), F.when(k % 2 == 0, 9).alias("last_page"), t.alias("at"))
    asked = old.join(runs.select("key"), "key", "left_semi")
    return progress.apply_runs(asked, runs).select("key", F.col("nextPage").alias("next_page"), F.col("offset").alias("start"), "found", "exhausted", "failures", "runs")


@query("skip_reasons", """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'exhausted' WHEN o_orderkey % 4 >= 2 AND o_orderkey % 5 < 2 THEN 'failing' END AS plain, CASE WHEN o_orderkey % 4 >= 2 AND o_orderkey % 5 < 2 THEN 'failing' END AS refreshed FROM orders""")
def _(spark, d):
    now = F.lit("2026-01-02 00:00:00").cast("timestamp")
    failed = now - F.make_dt_interval(F.lit(0), ((F.col("o_orderkey") % 5) * 12).cast("int"))
    rec = F.struct((F.col("o_orderstatus") == "F").alias("exhausted"), (F.col("o_orderkey") % 4).cast("int").alias("failures"), failed.alias("failedAt"))
    rows = table(spark, d, "orders")
    return rows.select("o_orderkey", progress.skip_reason(rec, now).alias("plain"), progress.skip_reason(rec, now, refresh=True).alias("refreshed"))


@query("breaker_trips", """WITH m AS (SELECT user_id, event_id, event_type, sum((event_type = 'click')::INT) OVER (PARTITION BY user_id ORDER BY event_id) AS since FROM events),
n AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id, since ORDER BY event_id) AS k FROM m WHERE event_type = 'error')
SELECT user_id, min(event_id) AS tripped_at FROM n WHERE k = 3 GROUP BY user_id""")
def _(spark, d):
    kind = F.col("event_type")
    return progress.trips(table(spark, d, "events"), "user_id", "event_id", kind == "error", kind == "click")


@query("robots_used_urls", """WITH p AS (SELECT page_id, regexp_extract(lower(url), '^([a-z]+://[^/?#]+)', 1) AS origin, regexp_replace(regexp_replace(url, '^[a-z]+://[^/?#]+', ''), '#.*$', '') AS path FROM pages),
s AS (SELECT *, CASE length(origin) % 3 WHEN 0 THEN 'rules' WHEN 1 THEN 'free' ELSE 'closed' END AS policy FROM p)
SELECT page_id, CASE policy WHEN 'free' THEN true WHEN 'closed' THEN false ELSE NOT regexp_matches(path, '[?]page=2') AND NOT starts_with(path, '/de/') END AS allowed FROM s""")
def _(spark, d):
    p = table(spark, d, "pages").select("page_id", F.regexp_extract(F.lower("url"), "^([a-z]+://[^/?#]+)", 1).alias("origin"), robots.request_path(F.col("url")).alias("path"))
    files = p.select("origin").distinct().withColumn("k", F.length("origin") % 3).select("origin", robots.policy(F.when(F.col("k") == 0, "204").when(F.col("k") == 1, "404").otherwise("503")).alias("policy"))
    rules = robots.parse(files.where("policy = 'rules'").select("origin", F.lit("User-agent: *\nDisallow: /*?page=2\nDisallow: /de/\n\nUser-agent: bot\nDisallow: /\n").alias("text")))
    return robots.allowed(p, rules, "origin", "path", "page_id", files=files).select("page_id", "allowed")


# ---------------------------------------------------------------- near-same pages


@query("line_jaccard_neardup", """WITH s AS (SELECT doc_id, list_sort(list_distinct(list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x)), lambda x: x <> ''))) AS ls FROM documents),
c AS (SELECT ls, min(doc_id) AS rep, count(*) AS times FROM s WHERE len(ls) > 0 GROUP BY ls),
l AS (SELECT a.rep, sum(b.times) AS more FROM c a JOIN c b ON a.rep <> b.rep AND len(a.ls) >= 0.8 * len(b.ls) AND len(b.ls) >= 0.8 * len(a.ls)
  AND len(list_intersect(a.ls, b.ls)) >= 0.8 * (len(a.ls) + len(b.ls) - len(list_intersect(a.ls, b.ls))) GROUP BY a.rep)
SELECT s.doc_id, coalesce(c.rep, s.doc_id) AS class_id, CAST(coalesce(c.times - 1, 0) + coalesce(l.more, 0) AS BIGINT) AS n_links FROM s LEFT JOIN c ON s.ls = c.ls LEFT JOIN l ON l.rep = c.rep""")
def _(spark, d):
    return extract.same_pages(table(spark, d, "documents"), "doc_id", "text")


# ---------------------------------------------------------------- review


@query("review_import_counts", """WITH r AS (SELECT doc_id, CASE WHEN toxic = 1 THEN 'ng' WHEN doc_id % 5 = 0 THEN '' WHEN doc_id % 7 = 0 THEN '1,2' || doc_id % 10 || '0名' ELSE '？' END AS mark, doc_id % 3 <> 0 AS known FROM labels),
s AS (SELECT *, mark IN ('ng') OR regexp_matches(mark, '[0-9]') AS said FROM r)
SELECT count(*) FILTER (said AND known) AS applied, count(*) FILTER (said AND NOT known) AS unknown, count(*) FILTER (NOT said) AS skipped FROM s""")
def _(spark, d):
    rows = table(spark, d, "labels")
    k = F.col("doc_id")
    mark = F.when(F.col("toxic") == 1, "ＮＧ").when(k % 5 == 0, "").when(k % 7 == 0, said("1,2", k % 10, "0名")).otherwise("？")
    blank = [F.lit("").alias(c) for c in ("industry", "contact", "identity", "employees_value", "contact_value", "official_value", "note")]
    sheet = rows.select(k.alias("seq"), said("ID-", k).alias("id"), F.lit("").alias("category"), mark.alias("employees"), *blank)
    ents = rows.where("doc_id % 3 <> 0").select(said("id", k).alias("entity_key"))
    none = spark.createDataFrame([], "entity_key string, seq long, field string, value string, source string, url string, snippet string")
    return review.imported(sheet, ents, none, "2026-01-01")[2]


@query("workset_pending", """WITH t AS (SELECT user_id, list(DISTINCT event_type) AS s, count(*) AS n FROM events GROUP BY user_id)
SELECT user_id, n % 2 = 0 AND NOT list_contains(s, 'view') OR n % 2 = 1 OR n % 3 = 0 AND NOT (list_contains(s, 'click') AND list_contains(s, 'error')) AS pending FROM t""")
def _(spark, d):
    names = {"view": "official", "click": "gbizinfo", "error": "mynavi", "signup": "careertasu", "purchase": "openwork"}
    source = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])[F.col("event_type")]
    per = table(spark, d, "events").groupBy("user_id").agg(F.collect_set(source).alias("sources"), F.count("*").alias("n"))
    rows = per.select(
        "user_id", "sources", (F.col("n") % 2 == 0).alias("has_official"), (F.col("n") % 3 != 0).alias("has_employees"), (F.col("n") % 3 != 0).alias("firm_employees"), F.lit(False).alias("no_prtimes"), F.lit(False).alias("no_gbiz"),
        F.lit(False).alias("no_mynavi"), F.lit(True).alias("no_careertasu"), F.lit(True).alias("no_openwork"))
    return rows.select("user_id", enrich.has_pending().alias("pending"))
