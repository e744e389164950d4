"""Production rules for Chinese-language film and series news.

All patterns, words and their order below are fixed values.
"""

from pressloom.rules.pack import RulePack, SignalRule

CHINESE = RulePack(
    name="zh",
    network=r"网络(?:公益)?电影|网络故事片|网大|云影院",
    film_title=r"电影|影片|(?iU)\b(?:film|movie|feature film|box office|theatrical release)\b",
    theatrical=r"院线电影|全国公映|影院上映|院线上映|正式上映|定档|预售|点映|票房",
    series_entry_types=("剧集动态", "电视剧动态", "网络剧动态"),
    series=r"电视剧|剧集|网剧",
    premiere=r"线上首映|全网首播",
    film=r"电影|影片",
    film_entry_type="电影",
    market_titles=(
        ("m-cn", "中国大陆|内地|国产|全国公映"),
        ("m-hmt", "香港|澳门|台湾|金马奖|金像奖"),
        ("m-intl", "好莱坞|北美|奥斯卡|戛纳|威尼斯|艾美奖"),
    ),
    dateline=(
        r"(?:中央社|中新社|中新网).*?"
        r"(?:洛杉磯|纽约|紐約|伦敦|倫敦|巴黎|首尔|首爾|东京|東京|柏林|釜山).*?(?:电|電|外電)"
    ),
    dateline_market="m-intl",
    award_market_title=r"中国电视金鹰奖|平遥国际电影展|飞天奖",
    title_only_keywords=("短剧", "微短剧"),
    long_form_words=("长剧", "电影", "电视剧", "院线"),
    social_ids=("taopiaopiao-official-posts", "dengta-official-posts"),
    media_title_words=("预告", "片花"),
    event_kinds=(
        ("filing", r"(?iU)备案|立项|filing"),
        ("run_end", r"(?iU)下映|结束公映|密钥到期"),
        ("award", r"(?iU)入围|提名|获奖|斩获|喜夺|特别表扬|费穆荣誉|获最佳|最佳.{0,8}奖|nomine|award|wins?\b"),
        ("box_office", r"(?iU)票房|预售|box.office|grosses?\b"),
        ("release_date", r"(?iU)定档|上映日期|公映|上映|首映|release.date|premiere"),
        ("music_asset", r"(?iU)\bMV\b|歌词海报|主题曲|歌曲|音乐特辑|music.video"),
        ("trailer", r"(?iU)预告|先导片|特别视频|片花|trailer|teaser"),
        ("poster", r"(?iU)海报|剧照|poster|first.look"),
        ("renewal", r"(?iU)续订|第二季|第三季|renew"),
        ("production", r"(?iU)开机|开拍|拍摄启动|杀青|production.begins|filming"),
        ("casting", r"(?iU)加盟|主演|选角|cast|star in"),
        ("rights", r"(?iU)发行|购得|版权|收购|rights|distribution|acquir"),
        ("review", r"(?iU)影评|评价|评论|review|critics?"),
        ("campaign", r"(?iU)广告|营销|宣发|campaign|new.ad"),
    ),
    fact_words=(
        r"(?iU)公布|发布|定档|上映|下映|公映|入围|提名|获奖|票房|预售|备案|立项|开机|开拍|杀青|"
        r"续订|发行|上线|播出|签约|购得|收购|启动|首映|刷新|突破|推出|宣布|释出|曝出|"
        r"release|premiere|acquir|renew|cast|box.office|gross|提档"
    ),
    event_facts={
        "filing": r"(?iU)备案|立项",
        "run_end": r"(?iU)下映|结束公映|密钥到期|同步网播|上线网播",
        "award": r"(?iU)入围|提名|获奖|斩获|获得.{0,15}奖",
        "box_office": r"(?iU)票房|预售|突破",
        "release_date": r"(?iU)定档|上映|公映|首映",
        "music_asset": r"(?iU)发布|释出|MV|歌词海报|歌曲",
        "trailer": r"(?iU)发布|释出|预告|先导片|特别视频",
        "poster": r"(?iU)发布|释出|海报|剧照",
        "renewal": r"(?iU)续订|renew",
        "production": r"(?iU)开机|开拍|杀青|拍摄",
        "casting": r"(?iU)主演|加盟|选角|cast",
        "rights": r"(?iU)发行|购得|版权|收购",
    },
    work=r"《([^》]{2,65})》",
    quoted_work=r"[‘'“\"]([^’'”\"]{3,65})[’'”\"]",
    amount=r"(?iU)\d+(?:\.\d+)?\s*(?:亿|万|billion|million)",
    advance=r"(?iU)预售|点映|presale",
    date=r"(?U)\d{1,2}月\d{1,2}日|\d{4}-\d{2}-\d{2}",
    song=r"(?iU)《([^》]{2,35})》\s*(?:MV|歌曲|歌词海报|主题曲)",
    material=r"[“「]([^”」]{2,35})[”」]",
    general_award=r"名单",
    award_series=r"飞天奖",
    award_series_name="飞天奖",
    award_list=r"入围|提名|名单",
    award_edition=r"(?U)第\d+届",
    award_edition_default="本届",
    person_title=r"文牧野",
    person_name="文牧野",
    signals=(
        SignalRule("advance_teaser", title=r"飞天奖", summary=r"即将|期待",
                   not_summary=r"作品名单公布|正式公布", social_only=True),
        SignalRule("background_roundup", title=r"(?iU)我们目前对.{0,60}了解的内容|你需要知道的|What We Know"),
        SignalRule("outside_film_tv", title=r"(?iU)美国偶像.{0,25}谋杀|American Idol.{0,25}murder"),
        SignalRule("promotion", title=r"饮品优惠|飲品優惠|購票優惠|购票福利|抽奖送|优惠券"),
        SignalRule("insufficient_detail", title=r"温馨提示|溫馨提示", not_title=r"《[^》]+》"),
        SignalRule("insufficient_detail", short_other=True),
        SignalRule("anniversary",
                   title=r"(?U)上映.{0,3}(?:\d+|[一二三四五六七八九十]+)周年|上映.{0,3}(?:\d+|[一二三四五六七八九十]+)年|周年回顾",
                   not_summary=r"新预告|新海报|定档|今日上映", social_only=True),
        SignalRule("advance_teaser", title=r"即将公布|期待入围名单|敬请期待|明日揭晓", social_only=True),
        SignalRule("promotion", title=r"饮品优惠|购票福利|抽奖送|优惠券", social_only=True),
    ),
    short_facts=(r"(?U)20\d{2}年|\d{1,2}月\d{1,2}日", r"执导|编剧|主演|定档|发布|获得"),
    lead_words=r"(?U)^(?:国庆档|重磅|独家[:：]?|全球现象级)\s*",
    sentence_break=r"[。！？；;]",
    clause_break=r"[，,]",
    number_cue=r"(?U)\d|[一二三四五六七八九十]月",
    fiction_cue=r"讲述|故事发生|饰演|期待|燃爽|震撼|一起走进|评论区",
    project=r"《([^》]{1,24})》",
    templates=True,
    default_tags=("影视圈",),
    closing_tag="电影宣发",
)
