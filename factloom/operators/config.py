"""Configuration as small tables.  Fixed values: source priorities and classes, categories and their words."""

PRIORITY = {
    "employees": ["human", "edinet", "official", "green", "grip", "mynavi", "careertasu", "gbizinfo", "houjingoo", "pitact", "salesnow", "agencyhub", "openwork", "imitsu", "wantedly"],
    "contactUrl": ["human", "official"],
    "address": ["human", "edinet", "official", "mynavi", "careertasu", "gbizinfo", "grip", "houjingoo", "pitact", "jcia", "openwork", "green", "salesnow", "wantedly", "imitsu"],
}
LISTING = ["boxil", "aspic", "buzztan", "webkanji", "meetsmore", "slidelib"]
ESTIMATES = ["salesnow", "agencyhub", "gbizinfo", "openwork"]
LOW_ESTIMATE, HIGH_ESTIMATE, LEAST_EMPLOYEES = 10, 40, 20
ITEMS = {"url": "公式URL", "address": "本社所在地", "estimate": "従業員数(推定値のみ)", "employees": "従業員数", "category": "カテゴリ", "contact": "問い合わせURL"}
STATUS = {"excluded": "除外", "OK": "OK", "check": "要確認"}

# Names of sources in remarks; job boards; estimates; sources that only enrich; words of a wider count.
SOURCE_LABELS = {
    "official": "公式サイト", "edinet": "有価証券報告書(EDINET)", "human": "人の確認", "green": "Green", "wantedly": "Wantedly", "mynavi": "マイナビ(新卒)", "careertasu": "キャリタス就活",
    "openwork": "OpenWork", "gbizinfo": "Gビズインフォ", "salesnow": "SalesNow", "agencyhub": "AgencyHub", "grip": "グリップ", "houjingoo": "全国法人", "pitact": "PITACT",
    "engage": "engage", "kyujinbox": "求人ボックス", "stanby": "スタンバイ",
}
RECRUITING = ["green", "wantedly", "mynavi", "careertasu", "openwork", "engage", "kyujinbox", "stanby"]
JOB_LISTS = ["kyujinbox", "stanby", "wantedly", "green", "engage"]
ENRICHING = ["official", "edinet", "salesnow", "prtimes", "gbizinfo", "mynavi", "careertasu", "openwork"]
RELIABILITY = {"edinet": 0, "official": 0, "green": 1, "grip": 1, "mynavi": 2, "careertasu": 2, "gbizinfo": 2, "houjingoo": 2, "pitact": 2, "salesnow": 3, "agencyhub": 3, "openwork": 3}
SCOPE = "連結|グループ(?:全体|合計|計|総数|スタッフ|従業員|人員)|当社グループ|関連会社|業務委託|派遣|うち日本|国内外|海外含"
STALE_YEARS = 3

# Official urls: sources from the most to the least trusted, sources that name a company's own site, hosts that are never one.
OFFICIAL_PRIORITY = ["human", "salesnow", "prtimes", "grip", "openwork", "buzztan", "webkanji", "boxil", "imitsu", "meetsmore", "slidelib", "wantedly", "aspic", "digimado"]
CORPORATE_SOURCES = ["salesnow", "prtimes", "grip", "buzztan", "webkanji", "boxil", "imitsu"]
REFUSED_HOSTS = [
    "wantedly", "green-japan", "imitsu", "facebook", "twitter", "x.com", "instagram", "youtube", "note.com", "prtimes", "google", "linkedin", "boxil", "aspicjapan", "buzztan", "digi-mado", "web-kanji",
    "biz.ne.jp", "meetsmore", "cone-c-slide", "grip-space", "goo.to", "pitact", "agencyhub", "jcia.org", "jaro.or", "openwork.jp", "career-tasu",
]

# Categories by key: label, words (groups that must all have a hit), largest headcount, and what the industry check looks for.
LABELS = {"cosme_d2c": "化粧品D2C/P2C", "influencer_agency": "インフルエンサー事務所", "ad_agency": "広告代理店", "sns_agency": "SNS運用代行"}
CATEGORIES = {
    "化粧品D2C/P2C": [
        ["化粧品", "コスメ", "スキンケア", "ヘアケア", "ボディケア", "美容液", "サプリメント"],
        ["D2C", "P2C", "DtoC", "公式通販", "公式オンラインストア", "公式オンラインショップ", "公式ストア", "自社ECサイト", "定期購入", "定期便", "自社ブランド"],
    ],
    "インフルエンサー事務所": [
        ["インフルエンサー", "YouTuber", "TikToker", "クリエイター"],
        ["インフルエンサー事務所", "クリエイター事務所", "YouTuber事務所", "インフルエンサーマネジメント", "クリエイターマネジメント", "マネジメント事業", "所属インフルエンサー", "所属クリエイター", "所属タレント", "キャスティング"],
    ],
    "広告代理店": [["広告代理", "アドエージェンシー", "Web広告", "運用型広告", "広告運用", "ネット広告", "デジタル広告", "広告事業"]],
    "SNS運用代行": [["SNS運用", "SNSアカウント運用", "SNSマーケティング", "Instagram運用", "TikTok運用", "SNS代行", "SNSコンサル", "SNS広告"]],
}
MOST_EMPLOYEES = {"ad_agency": 2000}
INDUSTRY = {
    "cosme_d2c": {
        "main": ["化粧品", "コスメ", "スキンケア", "ヘアケア", "ボディケア", "美容液", "サプリメント"],
        "extra": ["D2C", "P2C", "DtoC", "公式通販", "公式オンラインストア", "公式オンラインショップ", "公式ストア", "オンラインストア", "オンラインショップ", "自社EC", "定期購入", "定期便", "直営店", "通販"],
        "extra_label": "直販(D2C/公式通販など)",
    },
    "influencer_agency": {
        "main": ["インフルエンサー", "YouTuber", "TikToker", "クリエイター"], "extra": ["インフルエンサー事務所", "クリエイター事務所", "マネジメント", "キャスティング", "所属"],
        "extra_label": "事務所・マネジメント・キャスティング",
    },
    "ad_agency": {"main": ["広告代理", "広告運用", "運用型広告", "ネット広告", "インターネット広告", "Web広告", "デジタル広告", "アドエージェンシー", "アドテク", "広告事業"], "weak": ["広告", "マーケティング", "プロモーション"]},
    "sns_agency": {
        "main": ["SNS運用", "SNSマーケティング", "SNSアカウント運用", "Instagram運用", "TikTok運用", "SNS広告", "SNS代行", "SNSコンサル", "ソーシャルメディアマーケティング", "ソーシャルメディア運用"],
        "weak": ["SNS", "ソーシャルメディア", "インフルエンサー"],
    },
}
COMPETING = [
    "SaaS", "DX", "コンサルティング", "システム開発", "受託開発", "人材", "メディア運営", "ゲーム", "EC事業", "不動産", "金融", "データ分析", "ソフトウェア", "プラットフォーム", "マッチング", "クラウド", "出版", "製造",
    "フリーランス", "AI", "家具", "インテリア", "マットレス", "寝具", "求人", "採用支援", "採用代行", "雑誌", "スキルマーケット", "マーケットプレイス", "ECマーケティング", "EC支援", "ウィッグ", "育毛",
]
# The order in which the sources of a category are read, and sources that are not (blocked, or asked by name only).
ORDER = {
    "cosme_d2c": ["prtimes", "wantedly", "article", "salesnow", "jcia", "green", "jaro", "kyujinbox", "stanby", "indeed", "bizmaps", "doda", "mynavi", "engage"],
    "influencer_agency": ["boxil", "meetsmore", "aspic", "prtimes", "kyujinbox", "webkanji", "imitsu", "article", "wantedly", "green", "stanby", "indeed"],
    "ad_agency": ["grip", "webkanji", "imitsu", "boxil", "aspic", "meetsmore", "digitre", "agencyhub", "pitact", "houjingoo", "salesnow", "article", "digimado", "wantedly", "green", "doda", "indeed", "kyujinbox", "stanby", "mynavi", "engage"],
    "sns_agency": ["webkanji", "slidelib", "meetsmore", "aspic", "buzztan", "prtimes", "imitsu", "kyujinbox", "boxil", "digimado", "article", "wantedly", "stanby", "engage", "green", "grip", "indeed"],
}
BLOCKED = ["bizmaps", "indeed", "doda", "mynavi"]
BY_NAME = ["careertasu", "openwork", "edinet", "gbizinfo", "mynavi_shinsotsu"]
