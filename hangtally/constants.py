"""Fixed values of the business rules.

Everything in this module is a value that results depend on (size lists,
thresholds, event names, codes).  Logic lives elsewhere.
"""

# The size columns of a pivoted stock report, in report order.
BOTTOM_SIZES = [
    "25", "26", "27", "28", "29", "30", "31", "32", "33", "34", "35", "36", "37", "38",
    "39", "40", "42", "44", "ALLSIZE",
]
TOP_SIZES = ["FS", "XS", "SS", "S", "M", "L", "XL", "XXL", "XXXL"]
ALL_SIZES = BOTTOM_SIZES + TOP_SIZES

# Sizes counted when a size run is judged, and the least number in stock.
TOP_RUN = ["L", "M", "S", "XL", "XS", "XXL", "XXXL"]
TOP_RUN_WITH_FREE = ["FS", "L", "M", "S", "XL", "XS", "XXL", "XXXL"]
BOTTOM_RUN = [
    "25", "26", "27", "28", "29", "30", "31", "32", "33", "34",
    "35", "36", "37", "38", "39", "40", "42", "44",
]
BOTTOM_RUN_SALES = [
    "27", "28", "29", "30", "31", "32", "33", "34", "35", "36", "37", "38", "39", "40",
]
TOP_RUN_MIN = 3
TOP_RUN_MIN_WITH_FREE = 2
BOTTOM_RUN_MIN = 5
BROKEN, COMPLETE = "BROKEN", "SEHAT"

# The overlapping small / medium / large size groups.
SMALL_SIZES = ["25", "26", "27", "28", "29", "30", "S", "M"]
MEDIUM_SIZES = ["34", "33", "32", "30", "31", "L", "M"]
LARGE_SIZES = ["35", "36", "37", "38", "39", "40", "42", "44", "L", "XL", "XXL"]

# Event texts that decide the price class by themselves.
MARKDOWN_EVENTS = ["DISC 50%", "DISC 70%", "DISC 50+20%"]
NORMAL_EVENTS = ["NORMAL"]
CLASS_NORMAL, CLASS_MARKDOWN = "Normal", "Obral"

# From this price on, an article of the category counts as normal.
CATEGORY_PRICE_FLOOR = {
    "LONG SLEEVE SHIRT": 229000,
    "SHORT SLEEVE SHIRT": 229000,
    "LONG SLEEVE KOKO SHIRT": 229000,
    "SHORT SLEEVE KOKO SHIRT": 229000,
    "SHORT SLEEVE POLO SHIRT": 189000,
    "SHORT SLEEVE HENLEY SHIRT": 189000,
    "SHORT SLEEVE T-SHIRT (CREW NECK)": 139000,
    "LONG SLEEVE T-SHIRT (CREW NECK)": 192000,
    "TRUCKER JACKET PIECE DYED": 300000,
    "TRUCKER JACKET DENIM": 300000,
    "HERINGTON JACKET": 300000,
    "BOMBER JACKET": 300000,
    "UTILITIES JACKET": 300000,
    "HOODIE JACKET (KNIT)": 250000,
    "SWEAT SHIRT": 200000,
    "JOGER PANTS DENIM": 300000,
    "JOGER PANTS PIECE DYED": 300000,
    "JOGER SHORT DENIM": 279000,
    "5 POCKET PANT DENIM": 300000,
    "5 POCKET PANT PIECE DYED": 300000,
    "CHINO PANT PIECE DYED": 300000,
    "5 POCKET SHORT DENIM": 279000,
    "5 POCKET SHORT PIECE DYED": 279000,
    "CARGO PANT PIECE DYED": 300000,
    "CARGO SHORT PIECE DYED": 300000,
    "CHINO SHORT PIECE DYED": 279000,
    "CARGO PANT DENIM": 300000,
    "CARGO SHORT DENIM": 300000,
    "LONG SLEEVE UTILITIES SHIRT": 229000,
}

# Codes repaired on the way in.
SKU_REPAIRS = {"BBRD103V042333-": "BBRD103V042333"}
STORE_CODE_REPAIRS = {"MD185": "MD185."}
STORE_CODE_REPAIR_CITY = "Surabaya"
EVENT_REPAIRS = {"DISC 50+20%": "DISC 50%+20%"}

# Tax divisor, tax rate, status letters.
TAX_DIVISOR = 1.11
TAX_RATE = 0.11
VOID = "F"
FINAL = "X"
CLOSED = "T"
NO_MARGIN, WITH_MARGIN = "X", "O"

# Store master constants.
FIRST_SPARE_STORE_ID = 9000
STRATEGIC_STORES = [18, 27, 74, 117, 134, 137, 151, 116]
STRATEGIC_LABEL = "7 Toko Strategis"
BAZAAR_GROUP = 9
BAZAAR_LABEL = "Bazar"
BAZAAR_CODE_PREFIX = "BZ"
ONLINE_GROUP = 404
ZERO_DROP_STORES = [1131, 1130, 1129]
OLD_STOCK_DAYS = 12
TOP_SIZE_SHARE = 0.5
DIFF_TOLERANCE = 0.1
WAREHOUSE_TYPES_FOR_STOCK = ["RETUR", "PUSAT", "KONSINETTO", "QC"]

# Tags of the movement ledger.
RECEIVE = "receive"
ADJUST_IN, ADJUST_OUT = "adj_in", "adj_out"
SALE, SALE_VOID = "penjualan", "b_penjualan"
RETURN, RETURN_VOID, RETURN_PART = "retur", "b_retur", "b_retur2"
TRANSFER, TRANSFER_VOID, TRANSFER_PART = "mutasi", "b_mutasi", "b_mutasi2"

MONTH_NAMES = ["jan", "feb", "mar", "apr", "may", "jun",
               "jul", "aug", "sep", "oct", "nov", "dec"]
