"""Parsers of list and detail pages: one row in, an array of records out, all inside the row.

Every parser is a column expression over a prepared page (``ls``: its lines,
``part``: the lines of its labelled section, ``anchors``, ``title``, ``text``), so a
page is never exploded or shuffled to be read.  Records share one shape (``RECORD``).

Fixed values: the labels, marks and link shapes of each source's pages.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import figures, geo, text, urls

RECORD = ["name", "ref", "address", "employees", "note", "profile", "job", "place", "official_url", "founded", "members"]
NUMBERS = {"employees", "members"}
CORP = "株式会社|有限会社|合同会社"
BODIES = f"{CORP}|一般社団法人|一般財団法人|医療法人|社会福祉法人|学校法人|Inc\\.?|Co\\.|Ltd"
PREFECTURES = "(東京都|北海道|京都府|大阪府|[一-龥]{2,3}県)"
SOCIAL = "x\\.com|twitter|facebook|youtube"

LISTS: dict[str, tuple[Callable[[], Column], dict]] = {}
DETAILS: dict[str, tuple[Callable[[], Column], dict]] = {}


def listing(source: str, **section):
    def keep(f):
        LISTS[source] = (f, section)
        return f

    return keep


def detail(source: str, **section):
    def keep(f):
        DETAILS[source] = (f, section)
        return f

    return keep


# ------------------------------------------------------------------ pieces



def _c(name: str) -> Column:
    return F.col(name)


def record(**fields) -> Column:
    """A struct of ``RECORD``; what is not given is null, an empty text too."""
    def cell(name):
        value = fields.get(name, F.lit(None))
        return value.cast("bigint").alias(name) if name in NUMBERS else F.nullif(value.cast("string"), F.lit("")).alias(name)

    return F.struct(*[cell(n) for n in RECORD])


def first(array: Column, holds) -> Column:
    return F.try_element_at(F.filter(array, holds), F.lit(1))


def find(array: Column, holds) -> Column:
    """1-based place of the first element that holds; 0 for none."""
    return F.array_position(F.transform(array, lambda x: F.coalesce(holds(x), F.lit(False))), F.lit(True)).cast("int")


def find_last(array: Column, holds) -> Column:
    back = find(F.reverse(array), holds)
    return F.when(back > 0, F.size(array) - back + 1).otherwise(0)


def from_(array: Column, at: Column, n: Column | int | None = None) -> Column:
    """n elements from the 1-based place ``at`` on; none for a place below 1."""
    size = F.size(array) if n is None else (F.lit(n) if isinstance(n, int) else n)
    return F.when(at >= 1, F.slice(array, F.greatest(at, F.lit(1)), F.greatest(size, F.lit(0)))).otherwise(F.slice(array, 1, 0))


def line(array: Column, at: Column) -> Column:
    return F.when(at >= 1, F.try_element_at(array, F.greatest(at, F.lit(1))))


def after(array: Column, label: str) -> Column:
    """The line after the first line that is the label."""
    at = find(array, lambda x: x == label)
    return F.when(at > 0, line(array, at + 1))


def under(array: Column, label: str, labels: list[str]) -> Column:
    """The lines under the last line that is ``label``, up to the next label, as one text."""
    at = find_last(array, lambda x: x == label)
    rest = from_(array, F.when(at > 0, at + 1).otherwise(0))
    end = find(rest, lambda x: x.isin(labels))
    return F.when(at > 0, F.array_join(F.when(end > 0, from_(rest, F.lit(1), end - 1)).otherwise(rest), " "))


def tabbed(label: str) -> Column:
    """The value of a line "label<tab>value"."""
    return F.nullif(text.trimmed(F.regexp_extract("text", f"(?m)^{label}\\t(.+)$", 1)), F.lit(""))


def number(c: Column, shape: str) -> Column:
    """The first number of a folded text by a shape with one group."""
    return F.replace(F.regexp_extract(text.nfkc(c), shape, 1), F.lit(","), F.lit("")).try_cast("bigint")


def each(array: Column, make, keep) -> Column:
    """make(element, 0-based place) of the elements for which keep(element, place) holds."""
    numbered = F.transform(array, lambda x, i: F.struct(x.alias("x"), i.alias("i")))
    return F.transform(F.filter(numbered, lambda p: F.coalesce(keep(p["x"], p["i"]), F.lit(False))), lambda p: make(p["x"], p["i"]))


def once(array: Column, key: str) -> Column:
    """The first record of each key, in order."""
    keys = F.transform(array, lambda r: r[key])
    return F.filter(array, lambda r, i: F.array_position(keys, r[key]) == i + 1)


def linked(shape: str, ref, name=None, stop: tuple = ()) -> Column:
    """Records of the anchors whose address has the shape (its first group is the id), the first of each id."""
    def id_of(a):
        return F.regexp_extract(a["href"], shape, 1)

    found = F.filter(_c("anchors"), lambda a: a["href"].rlike(shape) & ~id_of(a).isin(list(stop) or ["\0"]))
    title = name or (lambda a: line(text.lines(a["text"]), F.lit(1)))
    return once(F.transform(found, lambda a: record(ref=ref(a, id_of(a)), name=title(a), note=id_of(a))), "note")


def outside(refused: str, over: str = "anchors") -> Column:
    """The first link to a host that is not refused."""
    return first(F.transform(F.col(over), lambda a: a["href"]), lambda h: h.rlike("^https?://") & ~urls.domain(h).rlike(refused))


def prepared(pages: DataFrame, start: str | None = None, stop: str | None = None) -> DataFrame:
    rows = pages.select("url", F.coalesce("title", F.lit("")).alias("title"), F.coalesce("text", F.lit("")).alias("text"), F.coalesce("anchors", F.array().cast("array<struct<href:string,text:string>>")).alias("anchors"))
    rows = rows.withColumn("ls", text.lines(F.col("text")))
    if not start and not stop:
        return rows.withColumn("part", F.col("ls"))
    begun = find(F.col("ls"), lambda x: x.rlike(start)) if start else F.lit(0)
    rows = rows.withColumn("part", from_(F.col("ls"), begun + 1))
    if stop:
        ended = find(F.col("part"), lambda x: x.rlike(stop))
        rows = rows.withColumn("part", F.when(ended > 0, from_(F.col("part"), F.lit(1), ended - 1)).otherwise(F.col("part")))
    return rows


def listed(pages: DataFrame, source: str) -> DataFrame:
    """(url, pos, RECORD...) of a source's list pages (url, title, text, anchors)."""
    make, section = LISTS[source]
    rows = prepared(pages, **section).select("url", make().alias("found"))
    return rows.select("url", F.posexplode("found").alias("pos", "r")).select("url", "pos", *[F.col(f"r.{c}").alias(c) for c in RECORD])


def detailed(pages: DataFrame, source: str) -> DataFrame:
    """(url, RECORD...) of a source's detail pages."""
    make, section = DETAILS[source]
    rows = prepared(pages, **section).select("url", make().alias("r"))
    return rows.select("url", *[F.col(f"r.{c}").alias(c) for c in RECORD])


def totals(pages: DataFrame, shape: str, per_page: int | None = None) -> DataFrame:
    """(url, total, pages): the number of hits that a list page states, and the pages that holds (one if it states none)."""
    found = number(F.col("text"), shape)
    many = F.ceil(found / per_page).cast("long") if per_page else F.lit(None).cast("long")
    return pages.select("url", found.alias("total"), F.coalesce(many, F.lit(1).cast("long")).alias("pages"))


#: How list pages state their hits.
TOTALS = {"salesnow": ("検索結果約?([0-9,]+)件中", 50), "kyujinbox": ("([0-9,]+)\\s*件\\s*[0-9]+\\s*ページ目", None), "stanby": ("求人・仕事・採用\\s*\\n\\s*([0-9,]+)\\s*\\n?\\s*件", None)}


# ------------------------------------------------------------ list sources


@listing("agencyhub")
def _():
    ls = _c("ls")
    begun = find(ls, lambda x: x == "詳細")
    ends = F.filter(F.transform(ls, lambda x, i: F.when(x == "詳細を見る", i + 1)), lambda p: p.isNotNull())
    spans = F.transform(ends, lambda e, k: F.struct(F.when(k == 0, begun).otherwise(F.try_element_at(ends, F.greatest(k, F.lit(1)))).alias("a"), e.alias("e")))
    blocks = F.transform(spans, lambda s: from_(ls, s["a"] + 1, s["e"] - s["a"] - 1))

    def make(b, _):
        size = text.nfkc(F.element_at(b, -1))
        low = F.regexp_extract(size, "^([0-9]+)\\s*[-〜~]\\s*[0-9]+名$|^([0-9]+)名以上$", 1)
        more = F.regexp_extract(size, "^([0-9]+)名以上$", 1)
        tags = from_(b, F.lit(3), F.size(b) - 4)
        return record(name=b[0], employees=F.coalesce(low.try_cast("bigint"), more.try_cast("bigint")), note=F.element_at(b, -1), profile=F.concat_ws(" ", F.array_join(tags, " "), b[1]))

    return each(blocks, make, lambda b, _: (F.size(b) >= 4) & b[0].rlike(CORP))


@listing("article")
def _():
    ls = _c("ls")
    stop = "^(まとめ|はじめに|目次|概要|特徴|料金|比較表|選び方|メリット|デメリット|注意点|おわりに|関連記事|この記事|よくある質問|FAQ|会社概要|サービス概要|実績|事例|口コミ|評判)"

    def named(x, i):
        ahead = from_(ls, i + 2, 8)
        says = lambda v: F.exists(ahead, lambda a: F.startswith(a, v) & F.substring(a, F.length(v) + 1, F.lit(1)).rlike("[はがの、，,]"))
        variants = text.heading_names(x)
        hit = first(variants, lambda v: (F.length(v) >= 2) & says(v))
        return F.when(hit.isNotNull(), F.coalesce(first(variants, lambda v: v.rlike(f"{CORP}|Inc\\.?|Co\\.,?\\s*Ltd")), hit))

    fit = lambda x, _: F.length(x).between(2, 45) & ~x.rlike("[。！？!?]") & ~x.rlike(stop) & ~x.rlike("とは$") & ~x.rlike(f"^{PREFECTURES}$")
    found = each(ls, lambda x, i: record(name=named(x, i), profile=x), fit)
    found = F.filter(found, lambda r: r["name"].isNotNull())
    return once(F.transform(found, lambda r: r.withField("note", F.regexp_replace(F.lower(text.nfkc(r["name"])), "\\s", ""))), "note")


@listing("aspic")
def _():
    return linked("^https://www\\.aspicjapan\\.org/asu/service/([0-9]+)(?:[?#].*)?$", lambda a, i: F.concat(F.lit("https://www.aspicjapan.org/asu/service/"), i))


@detail("aspic")
def _():
    own = first(_c("ls"), lambda x: x.rlike("SNS|運用") & (F.length(x) < 60))
    summary = F.regexp_replace(F.regexp_extract("text", "サービス概要\\n([\\s\\S]{0,400})", 1), "\\n+", " ")
    return record(name=tabbed("会社名"), address=F.regexp_replace(tabbed("所在地"), "^〒\\s*[0-9]{3}-?[0-9]{4}\\s*", ""), profile=F.concat_ws(" ", own, summary))


@listing("boxil")
def _():
    ls = _c("ls")
    found = linked("^https://boxil\\.jp/service/([0-9]+)/", lambda a, i: F.concat(F.lit("https://boxil.jp/service/"), i, F.lit("/")))

    def company(title):
        at = find(ls, lambda x: x == title)
        return F.when(at > 0, first(from_(ls, at + 1, 3), lambda x: x.rlike(f"{CORP}|Inc\\.|Co\\.|\\bLtd") & (F.length(x) < 50)))

    return F.filter(F.transform(found, lambda r: record(name=company(r["name"]), ref=r["ref"], profile=r["name"])), lambda r: r["name"].isNotNull() & r["profile"].isNotNull())


@detail("boxil")
def _():
    hrefs = F.transform("anchors", lambda a: a["href"])
    end = find(hrefs, lambda h: h.rlike("smartcamp\\.co\\.jp"))
    before = F.when(end > 0, from_(hrefs, F.lit(1), end - 1)).otherwise(hrefs)
    site = first(before, lambda h: urls.domain(h).isNotNull() & ~urls.domain(h).rlike(f"boxil\\.jp$|{SOCIAL}|tayori\\.com"))
    return record(official_url=site, profile=F.regexp_replace(F.regexp_extract("text", "サービス概要\\n([\\s\\S]{0,500})", 1), "\\n+", " "))


@listing("buzztan")
def _():
    ls = _c("ls")

    def make(x, i):
        ahead = from_(ls, i + 2, 5)
        end = find(ahead, lambda a: a.rlike("^運営会社\\t") | a.rlike("評判・費用について"))
        own = F.when(end > 0, from_(ahead, F.lit(1), end - 1)).otherwise(ahead)
        value = lambda label: F.regexp_extract(F.coalesce(first(F.reverse(own), lambda a: F.startswith(a, F.lit(f"{label}\t"))), F.lit("")), "\\t(.+)$", 1)
        upto = from_(ls, F.lit(1), i + 1)
        head = find_last(upto, lambda a: a == "項目\t内容") - 1  # 0-based
        near = (head >= 1) & (i - head <= 2)
        words = F.concat_ws(" ", F.when(near, line(ls, head - 1)), F.when(near, line(ls, head)))
        return record(name=text.trimmed(F.regexp_extract(x, "\\t(.+)$", 1)), address=value("所在地"), official_url=F.regexp_extract(value("公式URL"), "https?://[^\\s、,]+", 0), profile=words)

    return F.filter(each(ls, make, lambda x, _: x.rlike("^運営会社\\t.+")), lambda r: geo.in_tokyo(r["address"]))


@listing("digimado")
def _():
    return linked("^(https://digi-mado\\.jp/products/[0-9a-f-]{20,}/)", lambda a, i: i)


@detail("digimado", start="^運営企業情報$", stop="^この記事を共有する")
def _():
    labels = ["商号", "本社", "創立", "代表者名", "資本金", "URL"]
    site = outside(f"digi-mado|creativebank|{SOCIAL}")
    return record(name=under(_c("part"), "商号", labels), address=under(_c("part"), "本社", labels), official_url=site, job=text.trimmed(F.regexp_extract("title", "^(.+?)の特徴", 1)))


@listing("digitre")
def _():
    return F.filter(linked("^https://www\\.digi-tre\\.com/company/([\\w-]+)/?$", lambda a, i: F.concat(F.lit("https://www.digi-tre.com/company/"), i, F.lit("/"))), lambda r: r["name"].isNotNull())


@detail("digitre")
def _():
    ls = _c("ls")
    at = find(ls, lambda x: x == "所在地")
    rest = from_(ls, F.when(at > 0, at + 1).otherwise(0))
    end = find(rest, lambda x: x.rlike("^(代表|事業内容|設立|資本金|従業員|関連する地域)"))
    block = F.when(end > 0, from_(rest, F.lit(1), end - 1)).otherwise(rest)
    head = find(block, lambda x: x.rlike("^本社"))
    bare = F.transform(from_(block, head, 3), lambda x: text.trimmed(F.regexp_replace(F.regexp_replace(x, "^本社(?:所在地)?\\s*", ""), "^〒\\s*[0-9-]+\\s*", "")))
    address = first(bare, lambda x: (x != "") & ~x.rlike("^(?:本社|\\S*(?:営業所|支社|支店|オフィス)\\S*)$"))
    name = F.regexp_replace(F.regexp_replace(F.coalesce(after(ls, "会社名"), F.lit("")), "[（(][^）)]*[A-Za-z][^）)]*[）)]\\s*$", ""), "[（(][^）)]*英文[^）)]*[）)]", "")
    about = find(ls, lambda x: x == "会社案内")
    return record(name=text.trimmed(name), address=address, profile=F.concat_ws(" ", after(ls, "事業内容"), F.array_join(from_(ls, F.when(about > 0, about + 1).otherwise(0), 2), " ")))


@listing("engage")
def _():
    ls = _c("ls")
    company = lambda x: F.regexp_extract(x, "^(.{2,40}?) / (.+)$", 1)
    place = lambda i: first(from_(ls, i + 2, 5), lambda a: a.rlike(f"^{PREFECTURES}"))

    def make(x, i):
        return record(name=text.trimmed(company(x)), note=company(x), job=F.concat_ws(" ", line(ls, i), F.regexp_extract(x, "^(.{2,40}?) / (.+)$", 2)), place=place(i))

    return once(each(ls, make, lambda x, i: company(x).rlike(BODIES) & place(i).isNotNull()), "note")


@listing("green")
def _():
    def make(a):
        rows = F.filter(text.lines(a["text"]), lambda x: x != "New")
        count = first(rows, lambda x: x.rlike("^[0-9,]+人$"))
        return record(
            name=line(rows, F.lit(1)), note=F.regexp_extract(a["href"], "/company/([0-9]+)/job/[0-9]+", 1), employees=number(count, "([0-9,]+)人"), founded=first(rows, lambda x: x.rlike("^[0-9]{4}年設立$")),
            place=first(rows, lambda x: x.rlike("東京都|神奈川県|大阪府|フルリモート") & (F.length(x) < 60)), profile=text.clip(F.array_join(rows, " / "), 140),
            ref=F.concat(F.lit("https://www.green-japan.com/company/"), F.regexp_extract(a["href"], "/company/([0-9]+)/job/[0-9]+", 1)),
        )

    cards = F.transform(F.filter(_c("anchors"), lambda a: a["href"].rlike("/company/[0-9]+/job/[0-9]+")), make)
    named = once(F.filter(cards, lambda r: r["name"].isNotNull()), "note")
    return F.filter(named, lambda r: r["employees"].isNull() | (r["employees"] >= 20))


@detail("green", start="^企業情報$", stop="^この企業と同じ業界")
def _():
    labels = ["会社名", "業界", "企業の特徴", "設立年月", "代表者氏名", "事業内容", "株式公開（証券取引所）", "従業員数", "平均年齢", "本社住所", "資本金", "売上高"]
    g = lambda label: under(_c("part"), label, labels)
    address = F.coalesce(F.nullif(g("本社住所"), F.lit("")), geo.address(text.nfkc(text.flatten(F.col("text"))))["address"])
    return record(name=g("会社名"), address=address, employees=number(g("従業員数"), "([0-9,]+)人"), note=g("従業員数"), profile=F.concat_ws(" / ", F.nullif(g("業界"), F.lit("")), F.nullif(g("事業内容"), F.lit(""))), founded=g("設立年月"))


@listing("grip")
def _():
    return F.filter(linked("^https://grip-space\\.co\\.jp/(?:ad|web)-db/company/([0-9]+)/?$", lambda a, i: F.regexp_replace(a["href"], "/$", "")), lambda r: r["name"].isNotNull())


@detail("grip")
def _():
    about = F.regexp_replace(F.regexp_extract("text", "(?m)^会社について\\t([\\s\\S]*?)\\n\\n", 1), "\\n", " ")
    return record(name=tabbed("会社名"), address=tabbed("所在地"), official_url=tabbed("公式サイト"), employees=number(tabbed("従業員数"), "([0-9,]+)\\s*名"), note=tabbed("従業員数"), profile=about)


@listing("hikakubiz")
def _():
    ls = _c("ls")
    slug = "^https://www\\.biz\\.ne\\.jp/company/([A-Za-z0-9_-]+)/?$"
    slugs = F.array_distinct(F.filter(F.transform("anchors", lambda a: F.regexp_extract(a["href"], slug, 1)), lambda s: (s != "") & (s != "form")))
    marks = F.filter(F.transform(ls, lambda x, i: F.when(x == "企業を選択する", i + 1)), lambda p: p.isNotNull())

    def make(at, k):
        end = F.try_element_at(marks, k + 2)
        block = from_(ls, at + 1, F.when(end.isNull(), 24).otherwise(end - at - 1))
        features = find(block, lambda x: x == "特徴")
        work = after(block, "対応業務")
        own = F.try_element_at(slugs, k + 1)
        return record(
            name=line(block, F.lit(1)), ref=F.when(own.isNotNull(), F.concat(F.lit("https://www.biz.ne.jp/company/"), own, F.lit("/"))), address=first(block, lambda x: x.rlike(f"^{PREFECTURES}")),
            profile=F.concat_ws(" ", work, F.array_join(from_(block, F.when(features > 0, features + 1).otherwise(0), 3), " / ")),
        )

    return F.filter(F.transform(marks, make), lambda r: F.length(r["name"]) < 50)


@detail("hikakubiz")
def _():
    return record(official_url=outside(f"biz\\.ne\\.jp|google\\.|{SOCIAL}|instagram|line\\.me"), note=F.col("title"))


@listing("houjingoo")
def _():
    ls = _c("ls")
    begun = find(ls, lambda x: x.rlike("検索結果.*件中"))
    ends = F.filter(F.transform(ls, lambda x, i: F.when(x.rlike("^更新日："), i + 1)), lambda p: p.isNotNull())

    def make(e, k):
        a = F.when(k == 0, begun).otherwise(F.try_element_at(ends, F.greatest(k, F.lit(1))))
        block = from_(ls, a + 1, e - a - 1)
        address = first(block, lambda x: x.rlike(f"^{PREFECTURES}\\S*?[市区町村郡]") & (F.length(x) < 90))
        return record(
            name=first(block, lambda x: x.rlike(CORP) & (F.length(x) < 40)), address=text.trimmed(F.regexp_replace(address, "\\s+(求人情報提供|求人募集中).*$", "")),
            employees=number(F.array_join(block, " "), "従業員([0-9,]+)名"), note=text.clip(F.coalesce(first(block, lambda x: x.rlike("^本社")), F.lit("")), 100),
        )

    return F.filter(F.transform(ends, make), lambda r: r["name"].isNotNull())


@listing("imitsu")
def _():
    bare = lambda a: F.regexp_replace(a["href"], "#.*$", "")
    return linked("^https://imitsu\\.jp/[^/]+/pr-tokyo/[^/]+/supplier/([0-9]+)(?:#.*)?$", lambda a, i: bare(a))


@detail("imitsu", start="の会社情報$", stop="が紹介されている記事$")
def _():
    labels = ["会社名", "設立年", "住所", "会社URL", "会社概要", "従業員数", "資本金"]
    g = lambda label: under(_c("part"), label, labels)
    service = F.regexp_replace(F.regexp_extract("text", "サービス紹介\\n([\\s\\S]{0,500}?)\\n条件を変更", 1), "\\n", " ")
    return record(name=F.regexp_replace(g("会社名"), "_[0-9]{4,}$", ""), address=g("住所"), official_url=g("会社URL"), founded=g("設立年"), profile=F.concat_ws(" ", service, g("会社概要")))


@listing("jaro")
def _():
    ls = _c("ls")
    section = lambda x: text.trimmed(F.regexp_extract(x, "^(.{1,30}?)\\s*[（(][0-9]+社[）)]$", 1))
    heads = F.transform(ls, lambda x: F.nullif(section(x), F.lit("")))
    over = lambda i: F.element_at(F.filter(F.concat(F.array(F.lit("")), F.slice(heads, 1, i)), lambda h: h.isNotNull()), -1)
    return each(ls, lambda x, i: record(name=x, profile=over(i)), lambda x, i: (section(x) == "") & x.rlike(f"{CORP}|団体") & (F.length(x) < 40) & (over(i) != ""))


@listing("jcia")
def _():
    cells = F.transform(F.filter(F.split("text", "\n"), lambda x: F.contains(x, F.lit("\t")) & x.rlike(CORP)), lambda x: F.transform(F.split(x, "\t"), text.trimmed))
    rows = F.transform(cells, lambda c: record(name=c[0], address=F.try_element_at(c, F.lit(3)), official_url=F.when(F.try_element_at(c, F.lit(5)).rlike("^https?:"), F.try_element_at(c, F.lit(5)))))
    return F.filter(rows, lambda r: geo.in_tokyo(r["address"]))


def _jobs(place: str, refuse: str | None = None) -> Column:
    """A line that is a place, the line before it the company, the one before that the job."""
    ls = _c("ls")

    def keep(x, i):
        company = line(ls, i)
        fit = (i >= 2) & x.rlike(place) & company.rlike(BODIES) & (F.length(company) <= 40)
        return fit & ~company.rlike(refuse) if refuse else fit

    return once(each(ls, lambda x, i: record(name=line(ls, i), job=line(ls, i - 1), place=x), keep), "name")


@listing("kyujinbox")
def _():
    return _jobs(f"^{PREFECTURES}\\s")


@listing("stanby")
def _():
    return _jobs("^(東京都)?[^\\s／/]{1,8}[区市町村]$", "[／/]")


@listing("meetsmore")
def _():
    return linked("^https://meetsmore\\.com/products/([^/?#]+)/?(?:[?#].*)?$", lambda a, i: F.concat(F.lit("https://meetsmore.com/products/"), i))


@detail("meetsmore")
def _():
    company = first(_c("ls"), lambda x: x.rlike(f"^株?({CORP})") | x.rlike(f"({CORP})$"))
    clean = text.trimmed(F.regexp_replace(F.regexp_replace(company, "^株(?=株式会社)", ""), "[（(][^）)]*[）)]\\s*$", ""))
    return record(name=clean, official_url=F.regexp_extract("text", "製品URL\\s*\\n?\\s*(https?://\\S+)", 1))


@listing("pitact")
def _():
    ls = _c("ls")
    dated = lambda at: F.coalesce(line(ls, at).rlike("^更新日[:：]"), F.lit(False))

    def make(x, i):
        block = from_(ls, i + 3, 10)
        end = find(from_(block, F.lit(2)), lambda b: b.rlike("^更新日[:：]"))
        own = F.when(end > 0, from_(block, F.lit(1), end - 1)).otherwise(block)
        value = lambda label: F.nullif(after(F.concat(own, from_(ls, i + 3 + F.size(own), 1)), label), F.lit("--"))
        return record(name=x, address=value("住所"), employees=number(value("従業員数"), "([0-9,]+)\\s*人"), note=value("法人番号"))

    return each(ls, make, lambda x, i: dated(i + 2) & ~x.isin("法人番号", "住所", "電話番号", "従業員数"))


@listing("prtimes")
def _():
    found = linked("/main/html/searchrlp/company_id/([0-9]+)", lambda a, i: F.concat(F.lit("https://prtimes.jp/main/html/searchrlp/company_id/"), i), lambda a: text.trimmed(F.split(a["text"], "\n")[0]))
    return F.filter(found, lambda r: r["name"].isNotNull())


@detail("prtimes", start="^基本情報$", stop="^詳細情報$")
def _():
    labels = ["業種", "本社所在地", "電話番号", "代表者名", "上場", "資本金", "設立", "URL"]
    site = F.regexp_extract(under(_c("part"), "URL", labels), "https?://\\S+", 0)
    return record(address=under(_c("part"), "本社所在地", labels), official_url=site, profile=under(_c("part"), "業種", labels))


@listing("salesnow")
def _():
    return F.filter(linked("(.*/db/companies/[a-z0-9]+)$", lambda a, i: i, lambda a: text.trimmed(F.split(a["text"], "\n")[0])), lambda r: r["name"].isNotNull())


@detail("salesnow")
def _():
    flat = text.nfkc(text.flatten(F.col("text")))
    g = lambda shape: F.nullif(text.trimmed(F.regexp_extract(flat, shape, 1)), F.lit(""))
    return record(
        official_url=g("ホームページ \\| (https?://[^\\s|]+)"), address=g("住所\\(登記所在地\\) \\| ([^|]+)"), employees=number(flat, "正社員規模\\(推定\\) \\| ([0-9,]+)名"),
        founded=g("業歴 \\(設立年月\\) \\| [^|(]*\\(([0-9]{4}年[0-9]{1,2}月)設立\\)"), profile=text.clip(g("Powered by AI \\| ([^|]+)"), 300),
    )


@listing("slidelib")
def _():
    ls = _c("ls")
    links = F.transform(F.filter(_c("anchors"), lambda a: a["text"] == "サービスサイトへ"), lambda a: a["href"])

    def heading(x, i):
        ahead = F.coalesce(line(ls, i + 2), F.lit(""))
        base = text.trimmed(F.split(x, "[（(]")[0])
        said = (F.length(base) >= 2) & F.startswith(ahead, base) & F.substring(ahead, F.length(base) + 1, F.lit(1)).rlike("[はがの、]")
        return (x != "サービスサイトへ") & (F.length(x) <= 80) & ~x.rlike("^引用：") & (ahead.rlike("^引用：") | said)

    marked = F.transform(ls, lambda x, i: F.struct(x.alias("x"), F.coalesce(heading(x, i), F.lit(False)).alias("h"), (x == "サービスサイトへ").alias("go")))
    heads = F.filter(F.transform(marked, lambda m, i: F.when(m["h"], i)), lambda i: i.isNotNull())

    def make(i, k):
        end = F.coalesce(F.try_element_at(heads, k + 2), F.size(ls))
        own = F.slice(marked, i + 1, F.greatest(end - i, F.lit(1)))
        before = F.size(F.filter(F.slice(marked, 1, i), lambda m: m["go"]))
        x = ls[i]
        inner = F.regexp_extract(x, "[（(]([^）)]+)[）)]", 1)
        company = F.when(inner.rlike(f"{CORP}|Inc\\.?|Co\\.,?\\s*Ltd"), inner).otherwise(x)
        return record(name=text.trimmed(F.regexp_replace(company, "[（(][^）)]*特化[）)]\\s*$", "")), profile=x, official_url=F.when(F.exists(own, lambda m: m["go"]), F.try_element_at(links, before + 1)))

    return F.filter(F.transform(heads, make), lambda r: r["official_url"].isNotNull())


@listing("wantedly")
def _():
    found = linked("^https://www\\.wantedly\\.com/companies/([^/?#]+)$", lambda a, i: a["href"], lambda a: text.trimmed(F.split(a["text"], "\n")[0]))
    posts = F.filter(_c("anchors"), lambda a: a["href"].rlike("/projects/[0-9]+"))
    job = lambda i: text.clip(F.array_join(F.filter(text.lines(F.try_element_at(posts, i + 1)["text"]), lambda x: ~x.rlike("^(NEW|[0-9]+ entries)$")), " / "), 150)
    return F.transform(F.filter(found, lambda r: r["name"].isNotNull()), lambda r, i: r.withField("job", job(i)))


@detail("wantedly")
def _():
    ls = _c("ls")
    block = from_(ls, find(ls, lambda x: x == "会社情報"), 12)
    whole = text.nfkc(F.array_join(block, "\n"))
    site = F.coalesce(first(block, lambda x: x.rlike("^https?://")), first(F.transform("anchors", lambda a: a["href"]), lambda h: h.rlike("^https?://") & ~h.rlike("wantedly|facebook|twitter|instagram|youtube|x\\.com")))
    return record(address=geo.address(text.nfkc(F.array_join(block, " | ")))["address"], official_url=site, members=number(whole, "([0-9,]+)\\s*人のメンバー"), founded=F.regexp_extract(whole, "([0-9]{4}/[0-9]{1,2})\\s*に設立", 1), note=text.clip(F.array_join(block, " | "), 200))


@listing("webkanji")
def _():
    return linked("^https://web-kanji\\.com/companies/([A-Za-z0-9_-]+)/?$", lambda a, i: F.concat(F.lit("https://web-kanji.com/companies/"), i), stop=("industries", "objects", "features", "areas", "search"))


@detail("webkanji")
def _():
    ls = _c("ls")
    at = find(ls, lambda x: x == "特徴")
    titled = F.nullif(F.regexp_extract("title", "^(.+?)(?:の制作実績|の評判|｜|\\|)", 1), F.lit(""))
    name = F.coalesce(titled, first(ls, lambda x: x.rlike(CORP) & (F.length(x) < 40)))
    return record(name=name, official_url=outside(f"(-kanji\\.com|web-kanji\\.com)$|{SOCIAL}|instagram|line\\.me"), profile=F.array_join(from_(ls, F.when(at > 0, at + 1).otherwise(0), 11), " / "))


# -------------------------------------------------- sources asked by name


@listing("gbizinfo")
def _():
    raw = F.split("text", "\n")

    def make(x, i):
        cells = F.transform(F.split(F.coalesce(line(raw, i + 2), F.lit("")), "\t"), text.trimmed)
        value = lambda k: F.nullif(F.try_element_at(cells, F.lit(k)), F.lit("-"))
        return record(name=text.trimmed(F.replace(x, F.lit("\t"), F.lit(""))), address=value(2), founded=value(3), employees=number(value(5), "([0-9,]+)人"))

    row = lambda i: F.coalesce(line(raw, i + 2), F.lit(""))
    return each(raw, make, lambda x, i: F.startswith(row(i), F.lit("\t")) & (F.size(F.split(row(i), "\t")) >= 6) & (text.trimmed(F.replace(x, F.lit("\t"), F.lit(""))) != ""))


@listing("mynavi")
def _():
    raw = F.transform(F.split("text", "\n"), text.trimmed)
    squeeze = lambda c: F.regexp_replace(text.nfkc(c), "\\s+", "")

    def make(x, i):
        near = from_(raw, i + 2, 3)
        value = lambda shape: F.nullif(F.regexp_extract(F.coalesce(first(F.reverse(near), lambda a: a.rlike(shape)), F.lit("")), shape, 1), F.lit(""))
        title = line(raw, i)
        link = first(_c("anchors"), lambda a: a["href"].rlike("/corp[0-9]+/outline\\.html") & (squeeze(a["text"]) == squeeze(title)))
        return record(name=title, place=value("^本[\\s\\u3000]*社[\\s\\u3000]*(.+)"), note=value("^従業員[\\s\\u3000]*(.+)"), ref=F.regexp_replace(link["href"], "\\?.*$", ""))

    return each(raw, make, lambda x, i: (i >= 1) & x.rlike("^業[\\s\\u3000]*種") & (line(raw, i) != ""))


@detail("mynavi")
def _():
    field = lambda label: F.nullif(text.trimmed(F.regexp_extract("text", f"(?m)^{label}[\\t \\u3000]+(.+)$", 1)), F.lit(""))
    return record(address=F.regexp_replace(field("本社所在地"), "\\s+", " "), employees=number(field("従業員"), "^(?:グループ)?(?:連結)?\\s*([0-9,]+)\\s*(?:名|人)"), note=field("従業員"), founded=field("設立"))


@listing("careertasu")
def _():
    card = lambda a: text.lines(a["text"])
    shape = "^https://job\\.career-tasu\\.jp/corp/([0-9]+)/default/"
    found = F.filter(_c("anchors"), lambda a: a["href"].rlike(shape) & (F.size(card(a)) >= 2))
    return once(F.transform(found, lambda a: record(
        name=card(a)[1], place=geo.prefecture(card(a)[0]), ref=F.concat(F.lit("https://job.career-tasu.jp/corp/"), F.regexp_extract(a["href"], shape, 1), F.lit("/detail-uc/")))), "ref")


@detail("careertasu")
def _():
    ls = _c("ls")
    behind = lambda shape: (lambda at: F.when(at > 0, line(ls, at + 1)))(find(ls, lambda x: x.rlike(shape)))
    count = behind("^従業員数$")
    return record(address=behind("^本社所在地[0-9]?$"), employees=number(count, "^([0-9,]+)\\s*(?:名|人)"), note=count, founded=behind("^(?:創業/設立|設立)$"))


@listing("openwork")
def _():
    return F.filter(linked("^https://www\\.openwork\\.jp/company\\.php\\?m_id=(\\w+)", lambda a, i: F.concat(F.lit("https://www.openwork.jp/company.php?m_id="), i)), lambda r: r["name"].isNotNull())


@detail("openwork")
def _():
    ls = _c("ls")
    at = find(ls, lambda x: x == "企業情報")
    own = F.when(at > 0, from_(ls, at, 14)).otherwise(ls)
    size = after(own, "社員数")
    band = figures.headcount_range(text.nfkc(size))
    site = after(own, "URL")
    return record(address=after(own, "所在地"), official_url=F.when(site.rlike("^https?://"), site), employees=figures.range_to_point(band["min"], band["max"]), note=size, profile=after(own, "業界"))
