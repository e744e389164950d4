import datetime as dt

from pyspark.sql import functions as F

from pressloom.functions import classify as K
from pressloom.functions import package as P
from pressloom.functions import text as X
from pressloom.functions import times as D
from pressloom.functions import urls as U
from pressloom.policy import Policy
from pressloom.rules import CHINESE


def values(spark, rows, *columns):
    """Evaluate expressions over one text column ``x``."""
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, x string")
    out = df.select("i", *[c.alias(f"c{n}") for n, c in enumerate(columns)]).orderBy("i").collect()
    return [tuple(r)[1:] if len(columns) > 1 else r[1] for r in out]


def test_clean_text_decodes_layers_and_drops_markup(spark):
    rows = ["A &amp;amp;lt;b&gt; x", "<p>a</p>\n b <img src='x", "&nbsp;a　b ", "", "x &amp;amp;amp;amp; y"]
    assert values(spark, rows, X.clean_text(F.col("x"))) == ["A x", "a b", "a b", "", "x &amp; y"]


def test_title_key_keeps_words_of_any_script(spark):
    assert values(spark, ["《甲片》 É_t! 12", "—— !!"], X.title_key(F.col("x"))) == ["甲片é_t12", ""]


def test_search_text_folds_variants_for_matching_only(spark):
    assert values(spark, ["電影開機 Straße"], X.search_text(F.col("x"))) == ["电影开機 strasse"]


def test_compact_is_compatibility_form_without_zero_width(spark):
    rows = ["ＡＢ：１２　x​y", "ﬁlm ①", "a\t b"]
    assert values(spark, rows, X.compact(F.col("x"))) == ["AB:12 xy", "film 1", "a b"]


def test_visible_copy_drops_links_tags_and_tails(spark):
    row = "#新片# 片方公开预告 https://e.com/x @某人 敬请期待 更多"
    assert values(spark, [row], X.visible_copy(X.compact(F.col("x")))) == ["片方公开预告"]


def test_excerpt(spark):
    assert values(spark, ["a" * 10, "b" * 5 + "，" + "c" * 9], X.excerpt(F.col("x"), 10)) == ["a" * 10, "bbbbb，cccc…"]
    assert values(spark, ["ab，ccc"], X.excerpt(F.col("x"), 3)) == ["ab…"]


def test_canonical_url(spark):
    rows = ["https://example.com/article?id=1&utm_source=x#top", "https://e.com/a/?b&FBCLID=1", "https://e.com/x?q=a%20b~*"]
    assert values(spark, rows, U.canonical_url(F.col("x"))) == [
        "https://example.com/article?id=1", "https://e.com/a?b=", "https://e.com/x?q=a+b~%2A"]


def test_url_resolution(spark):
    base = F.lit("https://e.com/news/list.html?p=2")
    rows = ["/a/b", "//c.com/x", "d.html", "../up", "?p=3", "http://f.com", "javascript:x", "https://u:p@e.com/", ""]
    assert values(spark, rows, U.safe_url(F.col("x"), base)) == [
        "https://e.com/a/b", "https://c.com/x", "https://e.com/news/d.html", "https://e.com/up",
        "https://e.com/news/list.html?p=3", "http://f.com", "", "", ""]


def test_site_furniture_is_no_artwork(spark):
    rows = ["https://imgcdn.cna.com.tw/www/images/pic_fb.jpg", "https://imgcdn.cna.com.tw/www/webphotos/WebOg/600/story.jpg", "x"]
    assert values(spark, rows, U.usable_news_image(F.col("x"))) == [False, True, False]


def test_published_at_forms(spark):
    rows = ["Tue, 22 Sep 2026 10:10:00 +0800", "Tue Sep 22 10:10:00 +0800 2026", "22 Jul 2026 10:10 EST", "2026-09-23T03:00:00Z",
            "2026-09-23", "2026-09-23 03:00:00", "2小时前", "", "Wed, 02 Oct 02 15:00:00 GMT", "31 Feb 2026 10:00:00 GMT"]
    hit = values(spark, rows, D.iso_stamp(D.published_at(F.col("x"))))
    assert hit == ["2026-09-22T02:10:00Z", "2026-09-22T02:10:00Z", "2026-07-22T15:10:00Z", "2026-09-23T03:00:00Z",
                   "2026-09-23T00:00:00Z", "2026-09-23T03:00:00Z", None, None, "2002-10-02T15:00:00Z", None]


def test_local_date_is_wall_time_at_plus_eight(spark):
    rows = ["2026-09-30 16:38来自网页", "2026年9月3日 8:05", "2026-13-01 10:00", "2小时前"]
    assert values(spark, rows, D.iso_stamp(D.local_date(F.col("x")))) == ["2026-09-30T08:38:00Z", "2026-09-03T00:05:00Z", None, None]


def test_epoch_millis(spark):
    assert values(spark, ["1790753746000", "x"], D.iso_stamp(D.epoch_millis(F.col("x")))) == ["2026-09-30T07:35:46Z", None]


def _channel(spark, title, summary="", entry_type=None):
    df = spark.createDataFrame([(title, summary, entry_type)], "t string, s string, e string")
    folded = X.search_text(F.concat_ws(" ", "t", "s"))
    return df.select(K.classify_distribution(F.lit(None), F.col("t"), folded, F.col("e"), CHINESE)).first()[0]


def test_distribution_rules_in_order(spark):
    assert _channel(spark, "网络故事片《断桥夜行》定档", entry_type="剧集动态") == "network"
    assert _channel(spark, "新剧定档并全网首播", entry_type="剧集动态") == "series"
    assert _channel(spark, "影片全国公映", entry_type="电影动态") == "cinema"
    assert _channel(spark, "电影项目启动", entry_type="电影动态") == "film_unspecified"
    assert _channel(spark, "新劇集正式開機") == "series"
    assert _channel(spark, "Paper Lantern Feature Film Set", "Production begins soon", "剧集动态") == "film_unspecified"
    assert _channel(spark, "Another Harbour Lane Episode Arrives", "A series episode premieres", "剧集动态") == "series"
    assert _channel(spark, "天气") == "other"


def _excluded(spark, title, summary="", entry_type=None):
    policy = Policy(excluded_keywords=("短剧", "微短剧"), excluded_entry_types=("短剧动态",))
    df = spark.createDataFrame([(title, summary, entry_type)], "t string, s string, e string")
    return df.select(K.is_excluded(F.col("e"), X.search_text(F.col("t")), X.search_text(F.concat_ws(" ", "t", "s")), policy, CHINESE)).first()[0]


def test_short_drama_counts_in_the_headline_only(spark):
    assert not _excluded(spark, "为什么长剧不必短剧化")
    assert not _excluded(spark, "电影市场年度报告", "也讨论了短剧")
    assert _excluded(spark, "短劇新作開機")
    assert _excluded(spark, "新作开机", entry_type="短剧动态")


def test_market_of_the_story(spark):
    df = spark.createDataFrame([("膠卷博物館開門迎客", "（中央社洛杉磯8日綜合外電報導）"), ("中國大陸的春節檔期怎麼排", "")], "t string, s string")
    market = K.item_market(F.lit(True), F.lit("m-hmt"), X.search_text(F.col("t")), X.search_text(F.substring("s", 1, 100)), CHINESE)
    assert [r[0] for r in df.select(market).collect()] == ["m-intl", "m-cn"]


def test_confidence(spark):
    assert values(spark, ["industry_blog", "social", "official", "trade_media"], K.confidence(F.col("x"))) == [
        "industry_commentary", "social_lead", "official", "single_source"]


def test_names_in_text(spark):
    text = "《甲 片》由张三、李四领衔主演，王小明（赵六 饰）《甲片》《乙》"
    assert values(spark, [text], P.project_names(F.col("x"), CHINESE)) == [["甲片", "乙"]]
    names = values(spark, [text], P.actor_names(X.compatibility_form(F.col("x"))))[0]
    assert "张三" in names or "由张三" in names
    assert "李四" in names and len(names) <= 8


def test_card_and_labels(spark):
    card = P.card_title(F.col("x"), CHINESE)
    assert values(spark, ["《甲片》 定档，10月", "无片名"], card, P.card_event(F.col("x"), card)) == [("《甲片》", "定档，10月"), ("无片名", "")]
    assert values(spark, ["一句。二句。", ""], P.first_sentence(F.col("x"))) == ["一句。", "来源未提供可用摘要"]
    assert values(spark, ["official", "social_lead"], P.status_label(F.col("x"))) == ["已确认", "待确认"]
    assert values(spark, ["#新片今日发布# 正文", "第一句。第二句"], P.hashtag_headline(F.col("x"))) == ["新片今日发布", "第一句"]


def test_weekday_label(spark):
    df = spark.createDataFrame([(dt.date(2026, 9, 23),)], "d date")
    assert df.select(P.weekday_label(F.col("d"))).first()[0] == "周三"


def test_overlap_bounds_equal_the_plain_ratio(spark):
    import difflib
    import random

    from pressloom.functions.editorial import overlap_below, overlap_decision

    draw = random.Random(3)
    pairs = [("abcd", "xbcdy"), ("abc", "zzabczz"), ("", "abc"), ("票房突破三亿", "票房突破两亿元"), ("abc", "abc"), ("ab", "cd"), (None, "a"), ("😀a😀", "😀b😀c")]
    for _ in range(300):
        a = "".join(draw.choice("abc票房破亿😀") for _ in range(draw.randint(0, 40)))
        b = "".join(draw.choice(a + "xyz") for _ in range(draw.randint(0, 40))) if draw.random() < 0.5 else a[:draw.randint(0, 40)] + draw.choice(["", "x", "yz"]) + a[5:]
        pairs.append((a, b))
    pairs.append(("ab" * 150, "ba" * 140 + "c" * 20))
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, a string, b string").repartition(1).sortWithinPartitions("i")
    a, b = F.col("a"), F.col("b")
    for threshold in (0.45, 0.78):
        want = [None if x is None else True if not x or not y else False if x in y or y in x
                else difflib.SequenceMatcher(None, x, y).ratio() < threshold for x, y in pairs]
        got = df.select(overlap_below(a, b, threshold).alias("below"), overlap_decision(a, b, threshold).alias("by")).collect()
        assert [r.below if x is not None else None for r, (x, _) in zip(got, pairs)] == want
        # The bounds leave the ratio a part of the pairs only.
        assert 0 < sum(r.by == "ratio" for r in got) < 0.8 * len(pairs) and {"lengths", "letters"} <= {r.by for r in got}
