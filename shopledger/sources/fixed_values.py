"""The results only match when these do. Stated as they are, in natural order."""

# Exchange rates, units of each currency per EUR, as JSON text.
RATES_JSON = """{
  "EUR": "1.0", "USD": "1.1305", "JPY": "126.40", "BGN": "1.9558", "CZK": "25.592",
  "DKK": "7.4609", "GBP": "0.85970", "HUF": "315.51", "PLN": "4.2996", "RON": "4.7463",
  "SEK": "10.5375", "CHF": "1.1360", "ISK": "136.80", "NOK": "9.8040", "HRK": "7.4210",
  "RUB": "74.4208", "TRY": "6.1247", "AUD": "1.6072", "BRL": "4.2682", "CAD": "1.5128",
  "CNY": "7.5857", "HKD": "8.8743", "IDR": "15999.40", "ILS": "4.0875", "INR": "79.4320",
  "KRW": "1275.05", "MXN": "21.7999", "MYR": "4.6289", "NZD": "1.6679", "PHP": "59.083",
  "SGD": "1.5349", "THB": "36.012", "ZAR": "16.0583"
}"""

# Currencies a shopper may pick, and the default.
ALLOWED_CURRENCIES = ["USD", "EUR", "CAD", "JPY", "GBP", "TRY"]
DEFAULT_CURRENCY = "USD"

# Currency symbols.
CURRENCY_SYMBOLS = {"USD": "$", "CAD": "$", "JPY": "¥", "EUR": "€", "TRY": "₺", "GBP": "£"}
DEFAULT_CURRENCY_SYMBOL = "$"

# ISO 4217 codes.
ISO_CURRENCY_CODES = """
AED AFN ALL AMD ANG AOA ARS AUD AWG AZN BAM BBD BDT BGN BHD BIF BMD BND BOB BOV BRL BSD BTN BWP
BYN BZD CAD CDF CHE CHF CHW CLF CLP CNY COP COU CRC CUC CUP CVE CZK DJF DKK DOP DZD EGP ERN ETB
EUR FJD FKP GBP GEL GHS GIP GMD GNF GTQ GYD HKD HNL HRK HTG HUF IDR ILS INR IQD IRR ISK JMD JOD
JPY KES KGS KHR KMF KPW KRW KWD KYD KZT LAK LBP LKR LRD LSL LYD MAD MDL MGA MKD MMK MNT MOP MRU
MUR MVR MWK MXN MXV MYR MZN NAD NGN NIO NOK NPR NZD OMR PAB PEN PGK PHP PKR PLN PYG QAR RON RSD
RUB RWF SAR SBD SCR SDG SEK SGD SHP SLL SOS SRD SSP STN SVC SYP SZL THB TJS TMT TND TOP TRY TTD
TWD TZS UAH UGX USD USN UYI UYU UYW UZS VES VND VUV WST XAF XAG XAU XBA XBB XBC XBD XCD XDR XOF
XPD XPF XPT XSU XTS XUA XXX YER ZAR ZMW ZWL
""".split()

# Ads as (category, position within the category, redirect url, text).
ADS = [
    ("clothing", 0, "/product/66VCHSJNUP", "Tank top for sale. 20% off."),
    ("accessories", 0, "/product/1YMWWN1N4O", "Watch for sale. Buy one, get second kit for free"),
    ("footwear", 0, "/product/L9ECAV7KIM", "Loafers for sale. Buy one, get second one for free"),
    ("hair", 0, "/product/2ZYFJ3GM2N", "Hairdryer for sale. 50% off."),
    ("decor", 0, "/product/0PUK6V6EV0", "Candle holder for sale. 30% off."),
    ("kitchen", 0, "/product/9SIQT8TOJO", "Bamboo glass jar for sale. 10% off."),
    ("kitchen", 1, "/product/6E92ZMYYFZ", "Mug for sale. Buy two, get third one for free"),
]
ADS_SERVED_WITHOUT_MATCH = 2

# Flat shipping price in USD, and the letters of a tracking id.
SHIPPING_FLAT_UNITS = 8
SHIPPING_FLAT_NANOS = 990_000_000
TRACKING_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXY"

# Page limits.
RECOMMENDED_IDS = 5
RECOMMENDED_SHOWN = 4
SEARCH_LIMIT = 6
SESSION_SECONDS = 48 * 3600

# Histogram bounds.
LATENCY_BOUNDS = [0.1, 0.3, 0.5, 1, 2, 3, 5, 8, 13]
SCORE_BOUNDS = [0, 1, 2, 3, 4, 5, 8, 13]

# Patterns.
VISA_PATTERN = r"^4[0-9]{12}([0-9]{3})?([0-9]{3})?$"
MASTERCARD_PATTERN = (
    r"^(5[1-5][0-9]{14}|2(22[1-9]|2[3-9][0-9]|[3-6][0-9]{2}|7[01][0-9]|720)[0-9]{12})$"
)
EMAIL_PATTERN = r"^[A-Za-z0-9.!#$%&'*+/=?^_`{|}~-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+$"
IDENTIFIER_PATTERN = r"^[A-Za-z_][A-Za-z0-9_]*$"
WORD_BREAK_PATTERN = "[^a-z0-9]+"
SERVER_ID_PATTERN = r"\[([A-Za-z0-9_-]{3,64})\]"
CLIENT_ID_PATTERN = r"\[([a-zA-Z0-9-]+)\]"
LIST_TAIL_PATTERN = r"\n+[-*\d][\s\S]*"

# Assistant texts.
NO_MATCH = "NO_MATCH"
ID_FOOTER_LABEL = "推荐ID: "
SEARCH_PROMPT = "用户需求：{message}。请从商品目录中检索与以下房间风格最匹配的商品：{room}"
DESIGN_PROMPT = (
    "{instruction}\n"
    "房间风格描述：{room}\n"
    "候选商品信息：{candidates}\n"
    "用户诉求：{message}\n"
    "请先用 1-2 句话复述房间风格，再给出推荐理由和商品建议。"
    "若候选商品都不匹配，请明确说明。"
    "最后请按 [id1], [id2], [id3] 格式列出你认为最相关的 3 个商品 ID。"
)
DEGRADED_REPLY = (
    "当前智能推荐通道处于保护模式，已启用降级回复。"
    "\n你可继续描述偏好（当前输入：{message}），系统将返回基础推荐。\n推荐ID: [NO_MATCH]"
)

# Routes as (method list, kind of match, template).
ROUTES = [
    ("GET HEAD", "exact", "/"),
    ("GET HEAD", "segment", "/product/{id}"),
    ("GET HEAD", "exact", "/cart"),
    ("POST", "exact", "/cart"),
    ("POST", "exact", "/cart/empty"),
    ("POST", "exact", "/setCurrency"),
    ("GET", "exact", "/logout"),
    ("POST", "exact", "/cart/checkout"),
    ("GET", "exact", "/assistant"),
    ("", "prefix", "/static/"),
    ("", "exact", "/robots.txt"),
    ("", "exact", "/_healthz"),
    ("GET", "exact", "/metrics"),
    ("GET", "segment", "/product-meta/{ids}"),
    ("POST", "exact", "/bot"),
]
UNMATCHED_ROUTE = "unmatched"
