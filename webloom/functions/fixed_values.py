"""Patterns, word lists and labels that decide the results.

They are data. Change them through the parameters of the functions that use them.
"""

# Character classes
CJK = r"\x{4E00}-\x{9FA5}"
EMOJI = r"[\x{1F600}-\x{1F64F}\x{1F300}-\x{1F5FF}\x{1F680}-\x{1F6FF}\x{1F1E0}-\x{1F1FF}\x{2600}-\x{26FF}\x{2700}-\x{27BF}]"
SENTENCE_MARKS = "。！？"
COMMAS = "，,"

# Question rewriting: (pattern, replacement), applied in order
QUESTION_CLEANUP = [
    (r"你(知道|了解|听说|说|认为|觉得|见过|认识)", ""),
    (r"你?(告诉|给|跟)我(讲|说|推荐)?", ""),
    (r"为何", "为什么"),
    (r"[“”]", ""),
]
QUERY_REWRITE = [
    (r"^你?[有是否没能可以不]*(知道|听说过?|认为|觉得|见过|介绍一?下?|认识|告诉我?)", ""),
    (r"^你?(给|跟)我(讲|说)*", ""),
    (r"为[何啥]子?", "为什么"),
    (r"在那里?$", "在哪里"),
]
HOMELAND_PHRASES = r"我[国党们执]"
KEYWORD_SPACING = r"(第一|多少|为何|哪)"
TRAILING_QUESTION_MARK = r"？$"

# Question classification
FACT_EXEMPT = r"你知道|告诉我|我[国]"
FACT_DENY = r"你|我|几点|爸爸|妈妈"
FACT_ALLOW = [
    r"什么|最|第一|哪|谁|有没有|几|吗|如何|是|有多|[多最][快慢好坏强高少远长老久]|怎么?样?|啥|？",
    r"百科|距离|历史|介绍|信息",
]
SMALL_TALK = r"[你我].{0,5}[有会能可敢喜爱去来给拿要]"
FIXED_SKIP_PHRASE = "啪啪啪"
ANSWER_FILTER = r"？|[。、，！？·；]{2,100}|[我][是想和有的要也]|\.\.\.|\?"

# Chat cleanup
MENTION = r"@[\S]+\s+"
QUESTION_TAIL = r"[～~，。？！,：\.!\?\-\s]+$"
BRACKET_TAG = r"\[[^\]]+\]"
FACE_MARKS = r"[╮\(╯_╰\)╭…～（）［］【】~]+"
ANSWER_TAIL = r"[~，。？！,：\.!\?\-\s]+$"
ANSWER_FOREIGN = r"[^\x{4E00}-\x{9FA5}，。？！,\d\w\.!\?\-\s]"

# Screening of user questions: a match rejects the question
SCREEN_REJECT = [
    r"^[A-Za-z\*\x{E412}\~\{\}\(\)\[\]\+\?\^\$\"\\'\|\-\.\_\d\s,;/:<>!，。、！？（）＋‘’《》｛｝＊…～★【】“” ｜〈〉︿#％@=&`０１２３４５６７８９：；＜＞＠［］￥·—『』]+$",
    r"\x{E41D}|善哉|尼玛|释迦牟尼|六根|师兄|观音|菩萨|出家|般若|波罗蜜|修行|方丈|三宝|三藏|菩提|素斋|业障|宗派|五蕴|开悟|参禅|涅槃|慧根|我执|众生|心经|俗家|受戒|龙泉|和尚|法师|佛|禪|禅|丈|淫|寺",
    r"下一句|馅儿|轮回|出家|诗|僧|阿弥|色即是空|唵|经书|经文|男无|释迦|[念诵].{0,2}经",
    r"师[叔公妹哥母]|师父|贤二|二贤|师傅",
    r"[\dA-Za-z●☆]",
]
SCREEN_CLEAN = [
    (r"\x{E412}|\x{1F64F}|\.{3,}|\t|\[.{1,2}\]", ""),
    (r"/?:[A-Za-z\*\x{E412}\~\{\}\(\)\[\]\+\?\^\$\"\\'\|\-\.\_\d,;/:<>!，。、！？（）＋‘’《》｛｝＊…～★【】“” ｜〈〉︿#％@=&`０１２３４５６７８９：；＜＞＠［］￥·—『』]{1,4}", ""),
]
SCREEN_SPACED = r".+\s+.+"

# Entity names
PURE_CHINESE = r"^[\x{4E00}-\x{9FFF}]+$"
DISAMBIGUATION = r"^(.*)_\([^\)]+\)"
BRACKETED_NAME = r"^(.+?)(\(|（).+(\)|）)"
LABEL_TAG = r"</?[A-Za-z]+>"
ENTITY_NAME = r"^《?([\x{4E00}-\x{9FFF}·\-\ A-Za-z0-9]+)》?(\(|（)?[0-9,～\x{4E00}-\x{9FFF}]*(\)|）)?$"
GENERIC_SUFFIXES = [
    "股份有限公司", "运河", "商城", "半岛", "有限公司", "自然保护区", "自治县", "群岛",
    "问题", "运动", "县", "河", "岛", "区", "市", "自治州", "城", "公司", "技术", "工程", "山脉",
    "王朝", "高原", "研究所", "共和国", "古城",
]
RANGE_SUFFIX = ("山脉", "脉")
ALIAS_ATTRIBUTES = ["别名", "又称"]
ALIAS_LABELS = ["别名", "又称", "其他名称"]
CHINESE_NAME_ATTRIBUTE = "中文名"

# Price, news and record claims
MARKET_SUFFIX = "市场"
PLACE_WORDS = ["国内", "国外", "较广"]
SERIES_ATTRIBUTES = ["名称", "价格类型", "产地", "市场", "规格"]
PRICE_CLAIMS = ["商品名称", "日期", "价格", "价格单位", "产地", "报价地点", "规格", "币种"]
PRICE_UNIT = "元/千克"
CURRENCY = "CNY"
NEWS_TAG = "新闻"
NEWS_CLAIMS = ["标题", "摘要", "来源", "日期", "链接", "正文"]
NEWS_MARKETS = ["荷花池", "安国", "亳州", "玉林"]
PREFERRED_BOOK = "《中药大辞典》"
DEFINITION_CLAIM = "实体定义"
SOURCE_FIELD, ALIAS_FIELD = "来源", "别名"
ALIAS_CLEANUP = [
    (r"\[", "（"),
    (r"\]", "）"),
    (r"《", "（"),
    (r"》", " ）"),
    (r"（*?(（.*?）)?[^（]*?）", ""),
    (r"\((.*?)\)", ""),
    (r"。", ""),
    (r"，|,|;|、", "-"),
]
ENTITY_KEYWORDS = {
    "游戏": -100, "电影": -100, "本草": 50, "学名": 10, "中药名": 100, "中药材": 100,
    "纲目": 10, "熔点": 10, "药": 10, "化合物": 50, "分布": 10, "化学式": 10,
}
SAME_AS_KEYWORDS = {
    "中药": 100, "人物": -100, "电影": -100, "电视": -100, "演": -100, "植物": 50, "小说": -100, "草药": 50,
}

# Company names: ordered rules (see network.classify_company)
COMPANY_SHOP_END = r"[店市亭厅厂场厦库社处堂点吧]$"
COMPANY_SHOP_KEEP = r"(药店)$"
COMPANY_CREDIT, COMPANY_CREDIT_KEEP = r"(信用)", r"(莆田)"
COMPANY_ANIMALS = r"(动物|宠物|植物|庄稼|果蔬|兽医|蔬菜|兽药|压稼|禽|良种|农业)"
COMPANY_HOSPITAL_END = r"(医院|医院.*公司|医院.*分院)$"
COMPANY_INDUSTRY = (
    r"(通信|电力|银行|邮政|邮电|建设|水利|旅游|国有|铸造|建筑|百货|服饰|门市|商场|轴承|石油|钢铁|电器|火车|购物|制盐|矿物|报业|后勤"
    r"|机电|公路|建材|林业|纺织|金属|农用车|电气|设计院|重工|燃气|航空|航天|能源|农产品|盐业|工程|工业|食品|烟草|电子|工贸|电业|供销"
    r"|粮食|保险|交通|煤|水泥|铁通|电信|机械|汽车|葛洲坝|中信|代表处)"
)
COMPANY_SERVICES = (
    r"(\-|洗涤|服务|食堂|杂志|灯饰|发艺|内衣|塑料|燃料|服装|电缆|桥架|再生|石材|母婴|水产|轮胎|钢材|铺位|男装|装配|编辑部|餐饮"
    r"|专业合作社|农机|客运|招待所|加油站|浴室|小卖部|报刊|停车|物业|招待|回收|维修|园林|物流|矿产|种植|足浴|冷饮|经营|代理|餐厅"
    r"|舞厅|医院路|合作社|旅社|商行)"
)
MEDICAL_INVESTOR = [
    r"(医院|医疗|健康).*(投资|控股)", r"(医院|医疗|生物).*(管理)", r"(医院|医疗|健康).*(集团|集团.*公司)$",
]
HOSPITAL_NAME = [r"(医院|医院.*公司|医院.*分院)$", r"医院.*(肿瘤|孕).*中心$", r"(医院（|医院\()"]
CLINIC_NAME = r"([诊孕男女母婴药医疗泌尿]|健康|眼科|肿瘤|体检|康复|养老|美容|整形|护理|推拿)"
COMPANY_LABELS = ["医院投资", "医院公司", "门诊医疗"]
STRICT_MEDICAL_LABELS = ["医院投资", "医院公司"]
INVESTOR_ALWAYS = r"(莆田.*信用)"
INVESTOR_COMPANY = (r"(公司)$", r"(投资|控股)")
INVESTOR_GROUP = (r"(集团|集团.*公司)$", r"(医|药|保健)")
AGENT_COMPANY = (
    r"公司|投资|管理|协会|商会|商行|企业|商场|研究|经营|中心|基金|服务|银行|株式会社|咨询|经纪|商店|铁路|总厂|车行|贸易部|办公室|委员会"
    r"|街道|粮食局|交易|药品|集团|塑料|模具|出版|机械|纺织|车辆|水泥|拖拉机|化工|客车|柴油|钢厂|汽车|棉纺|乳品|电机|轴承|仪器|齿轮"
    r"|造船|加工|电器|清算|军械|教具|工厂|金店|Limited|Co.|公众股|集体股"
)

# Regions
PEOPLES = [
    "壮族", "满族", "回族", "苗族", "维吾尔族", "土家族", "彝族", "蒙古族", "藏族", "布依族", "侗族", "瑶族", "朝鲜族", "白族",
    "哈尼族", "哈萨克族", "黎族", "傣族", "畲族", "傈僳族", "仡佬族", "东乡族", "高山族", "拉祜族", "水族", "佤族", "纳西族",
    "羌族", "土族", "仫佬族", "锡伯族", "柯尔克孜族", "达斡尔族", "景颇族", "毛南族", "撒拉族", "布朗族", "塔吉克族", "阿昌族",
    "普米族", "鄂温克族", "怒族", "京族", "基诺族", "德昂族", "保安族", "俄罗斯族", "裕固族", "乌孜别克族", "门巴族",
    "鄂伦春族", "独龙族", "塔塔尔族", "赫哲族", "珞巴族", "各族",
]
REGION_RULES = {  # level: (removed when the whole rule matches, suffix removed from names longer than 2)
    "province": (r"(自治区|特别行政区)", r"(省|市)$"),
    "city": (r"^(市辖区|自治区直辖县级行政区划|省直辖县级行政区划|矿区|县|区)$|自治", r"(州|地区|市)$"),
    "district": (r"(市辖区|自治|郊区|城区)", r"(新区|林区|矿区|区|县|市)$"),
}

# Music catalogue
NAME_DOTS = ["·", "-", "‧", "(", ")", "•", "・"]
VERSION = r"[\(（](.*?)[\)）]"
ARTIST_SPLIT = r" x |;"
HOT_WEIGHTS = {"fans": 0.001, "shares": 0.599, "comments": 0.4}
TAG_PREFIXES = ["AN:", "BN:", "MN:", "VN:"]

# Pages
GLYPH_MARKER = "word-replace"
QUESTION_URLS = [  # label, pattern with one id group; the first match wins
    ("zhidao", r"zhidao.baidu.com/question/(\d+).html"),
    ("zybang", r"zybang.com/question/(.+).html"),
    ("muzhi", r"muzhi.baidu.com/question/(\d+).html"),
    ("baobao", r"baobao.baidu.com/question/(.+).html"),
    ("other", r"http://.+/question/(.+).html"),
]
TITLE_SUFFIX, TITLE_NOTICE = "_百度知道", "百度知道-信息提示"
TRUSTED_SOURCE, SKIPPED_SOURCE = "baike", "muzhi"

QUESTION_PAGE = {
    "content": r'accuse="qContent">(.*?)(</pre>|</div>)',
    "supplement": r'accuse="qSupply">(.*?)(</pre>|</div>)',
    "time": r'<em class="accuse-enter">.*\n*</ins>\n*(.*)\n*</span>',
    "asker": r'a class="user-name" alog-action="qb-ask-uname" rel="nofollow" href="http://www.baidu.com/p/(.*?)\?from=zhidao" target="_blank">',
    "answer_id": r'id="answer-(\d+)',
}
ANSWER_FIELDS = {  # output column: (JSON field, type)
    "question_id": ("encode_qid", "string"), "answer_id": ("id", "string"), "is_best": ("isBest", "int"),
    "is_recommend": ("isRecommend", "int"), "is_highquality": ("isHighQuality", "int"), "answer_time": ("createTime", "string"),
    "content": ("content", "string"), "agreement": ("valueNum", "int"), "disagreement": ("valueBadNum", "int"),
}
BOOK_BREAK = "<hr />"
SECTION_LABEL = "【.+?】"
HEADWORD = {
    "entry": r'(?s)<span id="span2" class="STYLE2">(.+?)</span.+?<span id="span14".+?</SRIPT>(.+?)</table>',
    "font": "<font", "font_mark": "red>", "unreadable": r"^[\x{E000}-\x{EFFF}]",
}
NOTICE_BOX = ('<div class="mainbox">', '<div id="footer">')
NOTICE_FIELDS = {"title": r"<h4[^>]*>([^<]*)", "public_date": r"<h5[^>]*>([^<]*)", "body": r"<pre[^>]*>([^<]*)"}
DUMP_BREAK, DUMP_LINK = "</>", "@@@LINK="
COMPANY_TERM, TERM_SPLIT, TERM_OPEN, MAP_LINK_TEXT = "营业期限：", "至", "无固定期限", "查看地图"

OVERALL_TREND = "总趋势"
QUOTE_UNITS = {"grain": "元/吨"}
QUOTE_CLAIMS = {"type": "报价类型", "agency": "报价机构", "place": "出产地", "grade": "等级"}
GRADE_KEY = "等级"
CONTRACT_CODE = "Pt9995"
HOLDER_CLAIMS = ["股东信息", "股东名称", "股东职务", "股东source_url"]
CHANGE_CLAIMS = ["变更记录", "变更项目", "变更时间", "变更前", "变更后"]
EXECUTIVE_CLAIMS = ["主要人员", "人员职务", "人员姓名"]
MATERIAL_PROPERTIES = ["物化性质", "分子式", "中文别名", "英文名称", "分子量"]
COUNTRY_FIELD = "国家"
DEFINITION_BREAK = "|||"
WIDE_PRICE_COLUMNS = [
    "productGrade", "priceCurrency", "createdTime", "confidence", "productPlaceOfOrigin", "maxPrice", "seller", "source", "tags",
    "productionYear", "unitText", "mainEntityOfPage", "mainEntityOfPage_raw", "sellerMarket", "minPrice", "productSpecification",
    "priceType", "description", "validMonth", "validDate",
]
