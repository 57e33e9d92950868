"""Classification, exclusion and region detection by ordered rules, as expressions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from showbill.functions import urls
from showbill.functions.text import clean_text, let, split_values

# Category codes of the feeds, public labels, and other names of labels.
CATEGORY_CODES = {
    "1": "音樂", "2": "表演", "3": "舞蹈", "4": "親子", "5": "音樂", "6": "美術", "7": "其他", "8": "電影", "11": "表演", "13": "競賽", "14": "其他", "15": "其他", "17": "音樂", "19": "其他",
}
LABELS = ["快閃", "美術", "攝影", "設計", "動漫", "歷史文化", "自然科學", "親子", "音樂", "表演", "舞蹈", "電影", "市集", "競賽", "科技", "其他"]
OTHER, COMPETITION = "其他", "競賽"
CATEGORY_NAMES = {
    "展覽": "美術", "展覽資訊": "美術", "藝術": "美術", "視覺藝術": "美術", "戲劇": "表演", "戲劇表演": "表演", "綜藝": "表演", "綜藝活動": "表演",
    "音樂表演": "音樂", "獨立音樂": "音樂", "演唱會": "音樂", "講座資訊": "其他", "親子活動": "親子", "電影欣賞": "電影", "競賽活動": "競賽", "徵選活動": "其他", "徵選": "其他", "商展": "其他",
    "研習課程": "其他", "其他藝文資訊": "其他",
}
# Regions in order of detection, spellings folded to them, and circles (latitude, longitude, radius in km).
REGION_SPELLINGS = {"臺北市": "台北市", "臺中市": "台中市", "臺南市": "台南市", "臺東縣": "台東縣"}
REGION_CIRCLES = {
    "台北市": (25.05, 121.54, 42), "新北市": (25.02, 121.47, 62), "基隆市": (25.13, 121.74, 28), "桃園市": (24.99, 121.30, 58), "新竹市": (24.81, 120.97, 26), "新竹縣": (24.84, 121.15, 58),
    "苗栗縣": (24.56, 120.82, 62), "台中市": (24.16, 120.68, 70), "彰化縣": (24.08, 120.54, 52), "南投縣": (23.91, 120.69, 86), "雲林縣": (23.71, 120.43, 58), "嘉義市": (23.48, 120.45, 24),
    "嘉義縣": (23.46, 120.57, 74), "台南市": (23.00, 120.22, 73), "高雄市": (22.63, 120.31, 94), "屏東縣": (22.55, 120.55, 102), "宜蘭縣": (24.68, 121.77, 76), "花蓮縣": (23.99, 121.61, 120),
    "台東縣": (22.76, 121.15, 126), "澎湖縣": (23.57, 119.58, 55), "金門縣": (24.44, 118.32, 36), "連江縣": (26.16, 119.95, 48),
}
UNKNOWN_REGION = "其他地區"
# Fixed patterns: keywords of labels; a later rule's label ranks before an earlier one's.
KEYWORDS = [
    ("快閃", r"(?i)快閃|期間限定|popup|pop-up"),
    ("攝影", r"(?i)攝影|影像展|photo(?:graphy)?"),
    ("動漫", r"(?i)動漫|動畫|漫畫|卡通|anime|公仔|角色展|模型展"),
    ("歷史文化", r"(?i)歷史|文化資產|文物|考古|古蹟|史料|地方誌|民俗"),
    ("自然科學", r"(?i)自然史|科學|生態|植物|動物|天文|地質|海洋|環境教育"),
    ("科技", r"(?iU)科技|人工智慧|(?<!\w)AI(?!\w)|數位科技|半導體|資訊展|電腦展|機器人"),
    ("設計", r"(?i)設計|建築|工藝|時尚|家居|文具|design"),
    ("舞蹈", r"(?i)舞蹈|舞作|芭蕾"),
    ("音樂", r"(?i)音樂|演唱會|樂團|管弦|獨立音樂|concert"),
    ("表演", r"(?i)戲劇|劇場|表演|歌劇|馬戲|音樂劇|偶戲"),
    ("電影", r"(?i)電影|(?<!攝)影展|放映"),
    ("市集", r"(?i)市集|祭典|嘉年華|展售|商品展|食品展|旅展|文創攤位"),
    ("親子", r"(?i)親子|兒童|家庭|幼兒"),
    ("競賽", r"(?i)競賽|比賽|大賽|徵件比賽"),
    ("美術", r"(?i)美術|藝術|繪畫|雕塑|裝置|當代|典藏|書畫|陶藝|視覺藝術|藝術博覽會|插畫博覽會"),
]
APP_KEYWORDS = [(n, r"(?i)科技|人工智慧|AI|數位科技|半導體|資訊展|電腦展|機器人") if n == "科技" else (n, p) for n, p in KEYWORDS]
# Fixed patterns: what the catalogue leaves out, and the exceptions.
EXCLUDED_TITLE = r"(?i)講座|講習|研習|研討會|論壇|座談|分享會|演講|課程|工作坊|營隊|訓練班|培訓班|讀書會"
EXCLUDED_CATEGORY = r"(?i)講座|講習|研習|課程|工作坊|營隊"
EXCLUDED_FEEDS = ("7", "19")
SMALL_ACTIVITY = (
    r"(?i)外展服務|繪本說故事|客語說故事|(?:親子|圖書館|故事媽媽).{0,8}說故事|說故事(?:活動|時間|場次)|故事時間|故事媽媽|親子共讀|社區共讀|"
    r"假日電影院|(?:圖書館|分館|鄉|鎮|區|里).{0,12}電影欣賞|文化走讀|深度走讀|城市走讀|導覽活動|借閱活動|閱讀推廣活動|"
    r"DIY|手作(?:活動|體驗|課)|(?:體驗|觀察|藝術|繪畫|書法|舞蹈|音樂|攝影)課|(?:夏令|冬令|成長|親子|藝術|科學)營|交流會|同樂會"
)
LOCAL_GOVERNMENT = r"(?i)(?:市|區|鄉|鎮)公所"
SMALL_SHOW = r"(?i)(?:社區|社團|學員|班級|志工|里民).{0,10}(?:成果展|聯展|展演|成果活動)"
CONTEST = r"(?i)競賽|比賽|大賽|初賽|複賽|決賽|徵件|徵選"
CONTEST_SHOW = r"(?i)得獎作品展|首獎典藏作品展|成果展|展覽|特展|音樂會|演唱會|公演|藝術節"
COMMUNITY = r"(?i)社區發展協會|里辦公處|里民活動|地方社團|地方性社團|同好會|居民活動|社區小聚|社團例會"
LOCAL_CLUB = r"(?i)(?:縣|市|鄉|鎮|區|里).{0,14}(?:協會|學會|社團|團委會)"
PUBLIC_SHOW = r"(?i)展覽|特展|常設展|作品展|成果展|聯展|個展|書展|攝影展|美術展|展演|音樂會|演唱會|演出|藝術節|電影節|博覽會|劇場|戲劇|舞蹈"
LARGE_EVENT = r"(?i)國際|全國|博覽會|美術館|博物館|文化局|文化中心|文化處"


@dataclass(frozen=True)
class Policy:
    """Which exclusions apply: the etl profile has all, the app profile a subset."""

    local_government: bool = True
    small_show: bool = True
    contest: bool = True


POLICIES = {"etl": Policy(), "app": Policy(False, False, False)}


def excluded(title, organiser=None, category=None, source=None, feed=None, profile: str = "etl") -> Column:
    """Whether the catalogue leaves a record out. Missing columns and nulls never exclude."""
    text = lambda c: clean_text(c if c is not None else F.lit(""))
    policy = POLICIES[profile]
    read = F.struct(text(title).alias("t"), text(category).alias("g"), F.concat_ws(" ", text(title), text(organiser)).alias("both"))

    def tests(r: Column) -> Column:
        t, g, both = r["t"], r["g"], r["both"]
        large = both.rlike(LARGE_EVENT)
        out = [t.rlike(EXCLUDED_TITLE), t.rlike(SMALL_ACTIVITY), g.rlike(EXCLUDED_CATEGORY), both.rlike(COMMUNITY) & ~large, both.rlike(LOCAL_CLUB) & ~t.rlike(PUBLIC_SHOW) & ~large]
        return any_of(out + [both.rlike(LOCAL_GOVERNMENT)] * policy.local_government + [both.rlike(SMALL_SHOW)] * policy.small_show + [t.rlike(CONTEST) & ~t.rlike(CONTEST_SHOW)] * policy.contest)

    return any_of([let(read, tests), *([text(feed).isin(*EXCLUDED_FEEDS)] if feed is not None else []), *([urls.is_blocked(source)] if source is not None else [])])


def any_of(tests: list[Column]) -> Column:
    out = F.lit(False)
    for t in tests:
        out = out | F.coalesce(t, F.lit(False))
    return out


def keyword_labels(text: Column, rules: list[tuple[str, str]]) -> Column:
    """The labels of matching rules, later rules first."""
    return let(text, lambda t: F.array_compact(F.array(*[F.when(t.rlike(p), F.lit(n)) for n, p in reversed(rules)])))


def classify(category, title, description, feed=None, rules: list[tuple[str, str]] | None = None, most: int = 3) -> Column:
    """Up to three labels: keyword labels that aren't named already, later rules first, then the named ones; `other` if none."""
    rules = KEYWORDS if rules is None else rules
    named = F.concat(split_values(category), *([split_values(feed)] if feed is not None else []))
    known = F.create_map(*[F.lit(x) for k, v in ({n: n for n in LABELS} | CATEGORY_NAMES | CATEGORY_CODES).items() for x in (k, v)])
    mapped = F.array_distinct(F.array_compact(F.transform(named, lambda v: F.try_element_at(known, v))))
    found = keyword_labels(F.concat_ws(" ", title, description), rules)
    labels = let(F.struct(mapped.alias("m"), found.alias("f")), lambda x: F.filter(F.array_distinct(F.concat(F.array_except(x["f"], x["m"]), x["m"])), lambda v: v != OTHER))
    return let(labels, lambda x: F.when(F.size(x) == 0, F.array(F.lit(OTHER))).otherwise(F.slice(x, 1, most)))


def editorial_labels(categories, title, description) -> Column:
    """Allowed labels without the contest label; inferred from the text if none is left."""
    allowed = F.array(*[F.lit(x) for x in LABELS if x != COMPETITION])
    kept = F.array_distinct(F.filter(F.transform(F.coalesce(F.col(categories), F.array()), lambda x: clean_text(x)), lambda v: F.array_contains(allowed, v)))
    inferred = F.filter(classify(F.lit(""), clean_text(title), clean_text(description)), lambda v: v != COMPETITION)
    labels = F.when(F.size(kept) > 0, kept).otherwise(inferred)
    return F.when(F.size(labels) == 0, F.array(F.lit(OTHER))).otherwise(F.slice(labels, 1, 3))


def detect_region(*texts, profile: str = "etl") -> Column:
    """The first region, in list order, that the texts name. The etl profile folds spellings first, the app profile looks for plain names first."""
    def folded(t: Column) -> Column:
        for old, new in REGION_SPELLINGS.items():
            t = F.replace(t, F.lit(old), F.lit(new))
        return t

    seek = lambda text: let(text, lambda t: F.coalesce(*[F.when(F.contains(t, F.lit(r)), F.lit(r)) for r in REGION_CIRCLES]))
    plain = F.concat_ws(" ", *[clean_text(t) for t in texts])
    return let(plain, lambda t: F.coalesce(*([] if profile == "etl" else [seek(t)]), seek(folded(t)), F.lit(UNKNOWN_REGION)))


def poor_venue(venue) -> Column:
    """Empty, a placeholder, cut off, or only a district's name."""
    from showbill.functions.text import clean_place

    return let(clean_place(venue), lambda v: (v == "") | (v == "地點待確認") | F.contains(v, F.lit("場館資料整理中")) | v.rlike("[=＝]$") | v.rlike("^.{1,8}區(?:[（(].+[）)])?$"))
