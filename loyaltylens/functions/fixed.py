"""Codes and labels that the business data uses and that results must show as they are."""

# Sales channels
STORE_CHANNEL = "LCS"
ONLINE_CHANNEL = "TMALL"
ECOM_CHANNELS = ("TMALL", "DOUYIN", "DOUYIN_B2B")
ALL_CHANNELS = ("LCS", "TMALL", "DOUYIN", "DOUYIN_B2B")

# Order lines
EXCLUDED_STORE_SALES_TYPE = 3
NORMAL_ORDER = "normal"
RRP_SALES_TYPE = 1
EXCLUDED_DISTRIBUTOR = "LBR"

# Customer id kinds that identify a member
MEMBER_ID_KINDS = ("CRM_memberid", "DY_openid", "TMALL_kyid")

# Substrings of registration channels and distributors
STORE_MARK = "LCS"
MINI_PROGRAM_MARK = "WMP"

# Marketplace account bindings
BIND_ID_TYPE = "kyid"
BIND_PLATFORM = "taobao"
LINK_BELONG_TYPE = "registerOrBind"
LINK_CHANNELS = ("TMall", "Douyin")

# Attribute log
CRM_ID_PROPERTY = "usr_crm_member_id"
IN_SEGMENT = "1"

# Stores, calendar, products
OPEN_STATUS = "营业中"
DAY_ROW = "day"
ADULT_PRODUCT = "adult product"
ADULT_MIN_AGE = 13

# City bands
MATURITY_LABELS = {"Mature": "1_mature", "Core": "2_core", "Uprising": "3_uprising"}
UNSPECIFIED_BAND = "4_unspecified"
UNSPECIFIED_CITY_BAND = "unspecified"
NO_ORDER_CITY = "no order city"
OTHERS = "Others"
TOTAL = "TTL"
ALL_WITH_CITY = "all_have_city_information"
ALL_MEMBERS = "TTL_member_base"

# Age marks
AGE_MARK_PATTERN = "^([0-9]+)(?: ([0-9]+)/([0-9]+[^ /]*))?"
