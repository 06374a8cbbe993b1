"""Fixed values of the price domain: results depend on these exact entries."""

from __future__ import annotations

# Futures and fund instruments
# (name, ticker, unit, kg per unit, price units per dollar, category, description)
INSTRUMENTS = [
    ("Wheat Futures", "ZW=F", "bushel", 27.2155, 100, "futures", "Wheat Futures (CBOT)"),
    ("Corn Futures", "ZC=F", "bushel", 25.4012, 100, "futures", "Corn Futures (CBOT)"),
    ("Soybeans Futures", "ZS=F", "bushel", 27.2155, 100, "futures", "Soybean Futures (CBOT)"),
    ("Oats Futures", "ZO=F", "bushel", 14.515, 100, "futures", "Oats Futures (CBOT)"),
    ("Rough Rice Futures", "ZR=F", "cwt", 45.359237, 100, "futures", "Rough Rice Futures (CBOT)"),
    ("Wheat ETF", "WEAT", "share", None, 1, "etf", "Wheat ETF"),
    ("Corn ETF", "CORN", "share", None, 1, "etf", "Corn ETF"),
    ("Soybeans ETF", "SOYB", "share", None, 1, "etf", "Soybean ETF"),
    ("Agricultural Basket", "DBA", "share", None, 1, "etf", "Agricultural Basket ETF"),
]
SPIKE_CHECKED_TICKERS = ("ZR=F",)

# Exchange-rate providers
FX_PROVIDERS = ("NBU", "PrivatBank", "ExchangeRateAPI")

# Default exchange rates to USD
EXCHANGE_RATES = {"USD": 1.0, "EUR": 1.10, "UAH": 0.027}

# Default unit factors to metric tons
UNIT_FACTORS = {"ton": 1.0, "tonne": 1.0, "bushel": 0.0272155, "kg": 0.001, "lb": 0.000453592}

# Trading holidays
HOLIDAYS = ("2025-01-01", "2025-07-04", "2025-12-25")

# Default spelling map for commodity names, in match order
COMMODITY_NAMES = {
    "wheat": "Wheat",
    "corn": "Corn",
    "soybeans": "Soybeans",
    "barley": "Barley",
    "rapeseed": "Rapeseed",
    "usd": "USD",
    "eur": "EUR",
    "uah": "UAH",
}

# Default commodity attributes (type, category, unit)
COMMODITY_ATTRIBUTES = {
    "Wheat": {"type": "grain", "category": "cereals", "unit": "ton"},
    "Corn": {"type": "grain", "category": "cereals", "unit": "ton"},
    "Soybeans": {"type": "oil_crop", "category": "legumes", "unit": "ton"},
    "Barley": {"type": "grain", "category": "cereals", "unit": "ton"},
    "Rapeseed": {"type": "oil_crop", "category": "oil_seeds", "unit": "ton"},
}

# Seed rows of the reference dimensions
SEED_CURRENCIES = [
    (1, "USD", "US Dollar", "United States"),
    (2, "EUR", "Euro", "European Union"),
    (3, "UAH", "Ukrainian Hryvnia", "Ukraine"),
]
SEED_COMMODITIES = [
    (1, "Wheat", "grain", "cereals", "ton", None, "Ukraine"),
    (2, "Corn", "grain", "cereals", "ton", None, "Ukraine"),
    (3, "Soybeans", "oil_crop", "legumes", "ton", None, "Ukraine"),
    (4, "Barley", "grain", "cereals", "ton", None, "Ukraine"),
    (5, "Rapeseed", "oil_crop", "oil_seeds", "ton", None, "Ukraine"),
]
SEED_MARKETS = [
    (1, "Chicago CBOT", "CBOT", "United States", "America/Chicago", "08:00-19:00"),
    (2, "ICE London", "ICE", "United Kingdom", "Europe/London", "09:00-19:00"),
    (3, "Kyiv Exchange", "ICEECX", "Ukraine", "Europe/Kyiv", "09:00-17:00"),
]
SEED_SOURCES = [
    (1, "yfinance", "yfinance", "prices", 4, "daily", "https://finance.yahoo.com"),
    (2, "graintradecomua", "graintradecomua", "prices", 4, "daily", "https://www.graintrade.com.ua"),
    (3, "currency", "currency_api", "exchange_rates", 5, "daily", "https://exchangeratesapi.io"),
    (4, "tripoli_land", "tripoli_land_parser", "grain_offers", 3, "daily", "https://tripoli.land"),
]

# Landed web pages
OFFER_SITE = "https://graintrade.com.ua"
OFFER_LIST_URL = "https://graintrade.com.ua/birzha?Ad_page="
COMPANY_PAGE_URL = "https://tripoli.land/ua/companies/"
STORAGE_TYPES = ("Порт", "Елеватор")

# Companies expected in the elevator price feed (page slug, display name)
COMPANIES = {
    "nibulon": "Нібулон",
    "kernel": "Кернел",
    "lnz-group": "ЛНЗ Груп",
    "tas-agro": "ТАС АГРО",
    "astarta-kiev": "Астарта-Київ",
    "mhp": "МХП",
    "agroprosperis": "Агропросперіс (NCH)",
    "prodinvest-servis": "Продінвест-Сервіс",
    "prometey": "Прометей",
    "expograin": "Експогрейн",
    "mko-trans-servis": "МКО-Транс-Сервіс",
    "ukrzernoinvest-2013": "Укрзернінвест-2013",
    "ooo-spoteks-treyd": "СПОТЕКС-ТРЕЙД",
    "agromino": "Агроміно",
    "ags-grain": "АГС-ГРЕЙН",
    "greynheven": "Грейнхевен",
    "bruklin-kiev": "Бруклін-Київ",
    "ramburs": "Рамбурс",
    "kortiya-ukraina": "Кортія-Україна",
    "glenport": "Гленпорт",
    "ooo-vvt-grupp": "ВВТ-Груп",
    "almeyda-grup-almeida-group": "Алмейда Груп",
    "ooo-agrotreyd-2022": "Агротрейд 2022",
    "dileks-treyd-dilex-trade": "Ділекс Трейд",
}

# Local crop name to English crop name
CROP_NAMES = {
    "Кукурудза": "Corn",
    "Кукурудза фуражна": "Corn",
    "Кукурудза кремниста": "Corn",
    "Пшениця 1 клас": "Wheat 1st grade",
    "Пшениця 2 клас": "Wheat 2nd grade",
    "Пшениця 3 клас": "Wheat 3rd grade",
    "Пшениця 4 клас": "Wheat 4th grade",
    "Пшениця 5 клас": "Wheat 5th grade",
    "Пшениця фуражна": "Wheat 4th grade",
    "Пшениця неконд.": "Wheat 6th grade",
    "Пшениця тверда": "Durum wheat",
    "Ячмінь": "Barley",
    "Овес": "Oats",
    "Овес голозернистий": "Oats",
    "Рис": "Rice",
    "Жито": "Rye",
    "Тритікале": "Triticale",
    "Просо жовте": "Millet",
    "Просо біле": "Millet",
    "Просо червоне": "Millet",
    "Гречка": "Buckwheat",
    "Полба": "Einkorn wheat",
    "Соняшник": "Sunflower",
    "Соняшник високоолеїновий": "Sunflower high-oleic",
    "Соняшник кондитерський": "Confectionery sunflower seeds",
    "Ріпак": "Rapeseed",
    "Ріпак без гмо": "Rapeseed",
    "Горох зелений": "Green peas",
    "Горох жовтий": "Peas",
    "Люпин": "Lupine",
    "Боби": "White kidney beans",
    "Квасоля": "White kidney beans",
    "Нут": "Chick-peas",
    "Сочевиця": "Lentil",
    "Сочевиця зелена": "Lentil",
    "Соя": "Soybeans",
    "Соя без гмо": "Soybeans GMO-free",
    "Шрот соняшниковий": "Sunflower seed meal",
    "Жмих соняшниковий": "Sunflower oil cake",
    "Шрот соєвий": "Soybean meal",
    "Жмих сої": "Soybean cake",
    "Жмих ріпаку": "Rapeseed cake",
    "Шрот ріпаку": "Rapeseed coarse meal",
    "Жмих кукурудзи": "Corn cake",
    "Висівки пшениці": "Wheat mill offals",
    "Висівки кукурудзи": "Corn mill offals",
    "Олія соняшникова": "Sunflower oil",
    "Олія соєва": "Soybean oil",
    "Олія ріпакова": "Rapeseed oil",
    "Олія кукурудзяна": "Corn oil",
    "Борошно": "Wheat flour class 1",
    "Цукор": "Sugar",
    "Переробка сої": "Soy processing",
    "Сорго біле": "Sorghum white",
    "Сорго червоне": "Sorghum red",
    "Віка": "Vetch",
    "Гірчиця жовта": "Mustard seeds",
    "Гірчиця біла": "Mustard seeds",
    "Гірчиця чорна": "Mustard seeds",
    "Коріандр": "Coriander",
    "Льон": "Flax",
    "Льон золотий": "Flax",
    "Люцерна": "Lucerne",
    "Очеретянка": "Other",
}

# Notes carried by landed rows
NOTE_OK = "ok"
NOTE_PRICE_UNAVAILABLE = "price_unavailable"
NOTE_PROVIDER_UNAVAILABLE = "provider_unavailable"
NOTE_NO_ROWS = "no_rows_after_normalization"
NOTE_UNSUPPORTED = "unsupported_provider"
NOTE_PAGE_UNAVAILABLE = "page_unavailable"
NOTE_PAGE_EMPTY = "page_without_offers"
NOTE_COMPANY_EMPTY = "company_unavailable_or_empty"
