"""Word lists, patterns and lookup tables that results depend on."""

# --- entity names -----------------------------------------------------------
EDGE_NOISE_CHARS = "'\"`,，。.;；:：、/\\|+-_!！?？*"
DECORATIVE_CHARS = "✔️✓✘✖★☆"
PLACEHOLDER_ENTITY_NAMES = ("医生圈平台",)
ENTITY_KEYWORDS = (
    "医院", "总医院", "中医院", "妇幼保健院", "儿童医院", "人民医院", "社区卫生服务中心", "社区卫生服务站",
    "卫生服务中心", "卫生服务站", "卫生院", "卫生室", "卫生所", "门诊部", "门诊", "诊所", "医疗中心", "医学中心",
    "康复医院", "康复中心", "疗养院", "医务室", "分院", "院区", "附属医院", "附院",
)
STRICT_ENTITY_KEYWORDS = (
    "医院", "中医院", "人民医院", "妇幼保健院", "儿童医院", "总医院", "附属医院", "康复医院", "疗养院", "卫生院",
    "卫生所", "卫生服务中心", "卫生服务站", "社区卫生服务中心", "社区卫生服务站", "医疗中心", "分院", "院区",
)
SUSPICIOUS_ENTITY_WORDS = (
    "割包皮", "阳痿早泄", "阳痿", "早泄", "包茎", "生殖器疱疹", "宫颈糜烂", "不孕症", "不育症", "附件炎", "乳腺炎",
    "痤疮", "痔疮", "hpv",
)
PLACEHOLDER_PERSON_WORD = "医生"
REMOVED_CHARS = "丨｜∣·•／（）()【】[]「」『』“”\"'"
DECEASED_PATTERN = r"已故|去世|逝世|病逝|辞世|仙逝|卒于|享年|[（(]\d{4}\s*[—\-－–]\s*\d{4}[)）]"

# --- titles -----------------------------------------------------------------
MEDICAL_TITLES = (
    "主任医师", "副主任医师", "主治医师", "住院医师", "医师", "主任中医师", "副主任中医师", "主治中医师", "中医师",
    "主任药师", "副主任药师", "主管药师", "药师", "主任技师", "副主任技师", "主管技师", "技师", "主任护师",
    "副主任护师", "主管护师", "护师", "护士",
)
CONTAINED_TITLES = ("副主任医师", "主任医师", "主治医师", "住院医师", "医师")
TITLE_ALTERNATIVES = (
    "主任医师|副主任医师|主治医师|医师|主任中医师|副主任中医师|主治中医师|中医师|主任药师|副主任药师|主管药师|药师|"
    "主任护师|副主任护师|主管护师|护师|护士|技师|主管技师"
)
OTHER_TITLE = "其他"

# --- notices ----------------------------------------------------------------
BID, CANDIDATE, WIN, INTENTION = "招标公告", "候选人公告", "中标公告", "采购意向"
INTENTION_MODULES = ("政府采购", "自主选择进场-采购项目")
TRADE_TYPE_MODULES = ("工程建设", "自主选择进场-工程项目")
TRADE_TYPES = ("施工", "监理", "勘察", "设计", "其他")
ALLOWED_NOTICE_TYPES = {
    "工程建设": ("招标公告", "中（定）标候选人公示", "中标结果公示", "合同及履约"),
    "政府采购": ("采购需求(意向)", "采购公告", "采购合同"),
    "自主选择进场-工程项目": ("招标公告", "中（定）标候选人公示", "中标结果公示", "合同及履约"),
    "自主选择进场-采购项目": ("采购需求(意向)", "采购公告", "采购合同"),
}
NOTICE_BOARDS = {
    "中标结果公告": WIN, "中标公告": WIN, "成交公告": WIN, "结果公告": WIN, "结果公示": WIN, "中标结果通知": WIN,
    "招标公告": BID, "采购公告": BID, "项目信息": BID, "挂牌公告": BID, "挂牌项目": BID, "竞价公告": BID, "竞拍公告": BID,
    "采购意向": INTENTION, "采购意向公告": INTENTION, "意向公开": INTENTION,
    "中标候选人": CANDIDATE, "候选人公示": CANDIDATE, "候选人公告": CANDIDATE, "中标候选人公示": CANDIDATE,
    "预中标公告": CANDIDATE, "评标结果公示": CANDIDATE,
}
RESULT_NOTICE_WORDS = ("中标", "成交", "结果", "候选")
CONTRACT_WORDS = ("合同", "履约")
PROCUREMENT_METHODS = ("单一来源", "邀请招标", "竞争性谈判", "询价", "竞争性磋商", "公开招标")
OTHER_METHOD = "其他类型"
PARENT_TYPES = {
    "建设工程": "工程建设", "政府采购": "政府采购", "土地矿产": "土地矿产", "产权交易": "产权交易", "水利工程": "工程建设",
    "铁路工程": "工程建设", "交通工程": "工程建设", "园林绿化工程": "工程建设", "排污权交易": "排污权交易",
    "国有企业采购": "国有企业采购", "农村产权": "农村产权", "其他项目": "其他项目", "电力、新能源工程": "工程建设",
}
PROJECT_CLASSES = {
    "建设工程": "[2]", "政府采购": "[5]", "土地矿产": "[5]", "产权交易": "[5]", "水利工程": "[2]", "铁路工程": "[2]",
    "交通工程": "[2]", "园林绿化工程": "[2]", "排污权交易": "[5]", "国有企业采购": "[5]", "农村产权": "[5]",
    "其他项目": "[5]", "电力、新能源工程": "[2]",
}
DEFAULT_PROJECT_CLASS = "[5]"
RANK_WORDS = ("第一", "第二", "第三", "第四", "第五", "第六", "第七", "第八", "第九", "第十")
UNION_WORD = "联合体"
UNION_DENIALS = ("不接受联合体", "非联合体")
CONTACT_SUFFIX = r"[;；]\s*(?:联系人|联系电话|电话|联系方式)\s*[:：].*$"
FIELD_NAMES = {
    "项目编号(建议书编号)": "project_number", "项目编号": "project_number", "项目名称": "project_name",
    "采购方式": "procurement_method", "预算金额": "budget_amount", "采购需求": "procurement_requirements",
    "合同履行期限": "contract_period", "截止时间": "deadline", "项目联系人": "project_contact",
    "采购人名称": "procurement_unit", "采购单位": "procurement_unit", "采购人": "procurement_unit",
    "招标人": "procurement_unit", "招标单位": "procurement_unit", "建设单位": "procurement_unit",
    "转让方": "procurement_unit", "采购单位名称": "procurement_unit",
    "中标单位": "relation_company_name", "中标人": "relation_company_name", "成交供应商": "relation_company_name",
    "中标供应商名称": "relation_company_name", "供应商名称": "relation_company_name", "成交人": "relation_company_name",
    "第一中标候选人": "relation_company_name",
    "中标金额": "render_money", "中标金额(元)": "render_money", "中标价": "render_money", "中标信息": "render_money",
    "成交金额": "render_money", "成交价": "render_money", "投标报价": "render_money",
    "联系人": "contact_name", "联系人/联系电话": "contact_name", "联系电话": "contact_telephone",
    "联系方式": "contact_telephone",
}
KEEP_TEXT_MARKERS = ("发布人", "发布时间", "技术支持电话")
NOISE_EXACT_TEXTS = ("附件：", "相关附件：", "请点击此处下载", "关闭本页")
NOISE_BREADCRUMB = "当前位置"
NOISE_PREFIXES = (
    "PDF版招标文件", "请点击“我要参与”登录济南公共资源交易中心网站",
    '请点击"我要参与"登录济南公共资源交易中心网站', "ca办理及相关咨询请点击",
)
NOISE_HELP_PATH = "ca/index.jsp#nav-7"
NOISE_LOGIN_PATH = "/new_flogin/login.do"
# What the pages of the second site show when they keep a reader out.
PROBE_CAPTCHA, PROBE_SCRIPT, PROBE_SCRIPT_STATUS = "本站开启了验证码保护", ("__jsl_clearance_s", "document.cookie"), 521
PROBE_BLOCK, PROBE_BLOCK_STATUS = ("online-desc-con", "禁止访问", "访问过于频繁"), 403
# The labelled item that names a notice where the page has no title.
ITEM_BOX, ITEM_TITLE, ITEM_VALUE, ITEM_LABELS = "box-item", "item-title", "item-msg", ("项目名称", "标段名称")
# Fixed values of page cleaning.
GREETING = "尊敬的用户您好！"
BUTTON_VALUES = ("澄清答疑", "我要参与")
CLOSING_CALL, CLOSING_TEXT = "window.close", "关闭本页"
CHANGES_CLASS, CHANGES_TEXT = "bggg", "变更公告"
POPUP_CLASSES, POPUP_FRAME_ID = ("shows", "hide"), "cqdyifram"
FILE_MARKS = (".pdf", ".doc", ".docx", ".xls", ".xlsx", ".zip", ".rar", ".7z", "download", "attach", "file", "fj")
FILE_TEXT = "PDF版招标文件"
BLANK_DETAIL_TASKS = (("土地矿产", "招标公告"), ("土地矿产", "结果公示"))
BOILERPLATE_LINES = (
    r"^公告详情$", r"^当前位置.*$", r"^首页$", r"^>.*$", r"^公共资源交易编号[:：].*$", r"^发布日期[:：].*$",
    r"^尊敬的用户您好.*$", r"^链接地址$", r"^关闭本页$", r"^澄清答疑$", r"^我要参与$",
)
STRUCTURAL_ONLY_LABELS = ("公共资源交易编号", "发布日期")
SHELL_TITLE = "交易信息详情"
SHELL_CONTENT_MARKERS = ("divMainContent", "big_title", "table-box", "box-content", "item-title")

# --- labelled patterns ------------------------------------------------------
PROJECT_NO_PATTERNS = (
    r"(?:项目编号|招标编号|采购文件编号)\s*[：:]\s*([A-Za-z0-9\-]+)",
    r"\b([A-Z]{2,}[A-Z0-9\-]*\d{4,}[A-Z0-9\-]*)\b",
)
PARTY_PATTERNS = (
    r"(?:采购人名称|采购人|采购单位)\s*[：:]\s*([^\n]+)",
    r"招\s*标\s*人\s*[：:]\s*([^\n]+)",
)
PARTY_CUT = "法定代表人"
PHONE_LABELS = r"(?:联\s*系\s*方\s*式|联\s*系\s*电\s*话|电\s*话)"
PHONE_CHARS = r"([0-9０-９\-—、/,，；; ]+)"
PHONE_PATTERNS = (
    r"(?:项\s*目\s*负\s*责\s*人|项\s*目\s*联\s*系\s*人)\s*[：:]\s*[^\s，,；; ]+\s*" + PHONE_LABELS + r"\s*[：:]\s*" + PHONE_CHARS,
    PHONE_LABELS + r"\s*[：:]\s*" + PHONE_CHARS,
)
CONTACT_PATTERNS = (r"(?:项\s*目\s*负\s*责\s*人|项\s*目\s*联\s*系\s*人|联\s*系\s*人)\s*[：:]\s*([^\n，,；; ]+)",)
BUDGET_PATTERNS = (
    r"(?:预算金额|合同估算价|估算价|投资额)\s*[：:]?\s*([0-9][0-9,]*(?:\.\d+)?)\s*元",
    r"([0-9][0-9,]*(?:\.\d+)?)\s*元",
)
LISTING_PRICE_PATTERN = r"挂牌价格\s*[：:]\s*([0-9][0-9,]*(?:\.\d+)?\s*(?:万元|元))"
PAGE_TOTAL_PATTERN = r"共\s*(\d+)\s*页"

# --- money ------------------------------------------------------------------
RATE_WORDS = ("下浮率", "上浮率", "费率", "利率", "比例", "折扣", "税率")
DIGIT_CHARS = "零〇一壹二贰两三叁四肆五伍六陆七柒八捌九玖"
DIGIT_VALUES = "001122233445566778899"
SMALL_UNITS = {"十": 10, "拾": 10, "百": 100, "佰": 100, "千": 1000, "仟": 1000}
LARGE_UNITS = {"万": 10000, "萬": 10000, "亿": 100000000, "億": 100000000}

# --- codes ------------------------------------------------------------------
LEVEL_TEXT = {"1": "三", "2": "二", "3": "一"}
GRADE_TEXT = {"1": "", "2": "甲", "3": "乙", "4": "丙"}
LEVEL_SYNONYMS = {"三级甲等": "三甲医院", "三级乙等": "三乙医院", "二级甲等": "二甲医院", "二级乙等": "二乙医院"}
LEVEL_MARKERS = ("级", "甲等", "乙等")
OWNERSHIP_WORDS = ("公立", "私立", "民营")
COMPARISON_GLYPHS = {">=": "≥", "=": "=", "<=": "≤", "<": "<", ">": ">"}

# --- task ledger ------------------------------------------------------------
TASK_STATES = ("pending", "queued", "running", "waiting_retry", "blocked", "done", "failed", "cancelled")
TASK_TYPES = ("recon", "list_fetch", "detail_fetch", "search_fetch", "validate", "export")
TERMINAL_STATES = ("done", "failed", "cancelled")
ALLOWED_MOVES = (
    ("pending", "queued"), ("pending", "cancelled"),
    ("queued", "running"), ("queued", "waiting_retry"), ("queued", "blocked"), ("queued", "cancelled"),
    ("running", "done"), ("running", "waiting_retry"), ("running", "blocked"), ("running", "failed"),
    ("running", "cancelled"),
    ("waiting_retry", "queued"), ("waiting_retry", "blocked"), ("waiting_retry", "failed"),
    ("waiting_retry", "cancelled"),
    ("blocked", "queued"), ("blocked", "cancelled"), ("blocked", "failed"),
)
