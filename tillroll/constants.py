"""Defaults and fixed values."""

from __future__ import annotations

# Day names in ordinal order, Monday is 0.
WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]

# Trip types left out of itemset mining.
IGNORED_TRIP_TYPES = [8, 39, 9, 999, 40]

# Mining support, number of clusters, size of the UPC vocabulary,
# visits in a development sample.
MIN_SUPPORT = 0.0004
N_CLUSTERS = 8
TOP_UPCS = 2000
SAMPLE_VISITS = 5000

# Gross retail categories. A department may be in several.
RETAIL_CATEGORIES = {
    "Food": [
        "BAKERY", "CANDY, TOBACCO, COOKIES", "COMM BREAD", "COOK AND DINE", "DAIRY",
        "DSD GROCERY", "FROZEN FOODS", "GROCERY DRY GOODS", "MEAT - FRESH & FROZEN",
        "PRE PACKED DELI", "PRODUCE", "SEAFOOD", "SERVICE DELI",
    ],
    "Clothing": [
        "ACCESSORIES", "BOYS WEAR", "BRAS & SHAPEWEAR", "GIRLS WEAR, 4-6X  AND 7-14",
        "INFANT APPAREL", "JEWELRY AND SUNGLASSES", "LADIES SOCKS", "LADIESWEAR",
        "MENS WEAR", "MENSWEAR", "PLUS AND MATERNITY", "SHEER HOSIERY", "SHOES",
        "SLEEPWEAR/FOUNDATIONS", "SWIMWEAR/OUTERWEAR",
    ],
    "Electronics": [
        "1-HR PHOTO", "CAMERAS AND SUPPLIES", "ELECTRONICS", "MEDIA AND GAMING",
        "OTHER DEPARTMENTS", "PLAYERS AND ELECTRONICS", "WIRELESS",
    ],
    "Do_It_Yourself": ["AUTOMOTIVE", "HARDWARE", "LAWN AND GARDEN", "PAINT AND ACCESSORIES"],
    "Hobbies": [
        "BOOKS AND MAGAZINES", "CELEBRATION", "FABRICS AND CRAFTS",
        "HORTICULTURE AND ACCESS", "OFFICE SUPPLIES", "TOYS",
    ],
    "Household": [
        "BATH AND SHOWER", "BEDDING", "COOK AND DINE", "FURNITURE", "HOME DECOR",
        "HOME MANAGEMENT", "HORTICULTURE AND ACCESS", "HOUSEHOLD CHEMICALS/SUPP",
        "HOUSEHOLD PAPER GOODS", "LARGE HOUSEHOLD GOODS",
    ],
    "Specialty": [
        "1-HR PHOTO", "CONCEPT STORES", "LARGE HOUSEHOLD GOODS", "OPTICAL - FRAMES",
        "OPTICAL - LENSES", "OTHER DEPARTMENTS", "PHARMACY RX",
    ],
    "Discretionary": [
        "1-HR PHOTO", "ACCESSORIES", "AUTOMOTIVE", "BATH AND SHOWER", "BEAUTY",
        "BOOKS AND MAGAZINES", "CAMERAS AND SUPPLIES", "CANDY, TOBACCO, COOKIES",
        "CELEBRATION", "CONCEPT STORES", "COOK AND DINE", "ELECTRONICS",
        "FABRICS AND CRAFTS", "HEALTH AND BEAUTY AIDS", "HOME DECOR",
        "HORTICULTURE AND ACCESS", "IMPULSE MERCHANDISE", "JEWELRY AND SUNGLASSES",
        "LAWN AND GARDEN", "LIQUOR,WINE,BEER", "MEDIA AND GAMING", "OPTICAL - FRAMES",
        "PLAYERS AND ELECTRONICS", "SPORTING GOODS", "SWIMWEAR/OUTERWEAR", "TOYS", "WIRELESS",
    ],
    "Non_Discretionary": [
        "BAKERY", "BATH AND SHOWER", "BEAUTY", "BEDDING", "BRAS & SHAPEWEAR", "COMM BREAD",
        "COOK AND DINE", "DAIRY", "DSD GROCERY", "FINANCIAL SERVICES", "GROCERY DRY GOODS",
        "HEALTH AND BEAUTY AIDS", "HOUSEHOLD CHEMICALS/SUPP", "HOUSEHOLD PAPER GOODS",
        "INFANT CONSUMABLE HARDLINES", "LADIES SOCKS", "MEAT - FRESH & FROZEN", "MENS WEAR",
        "MENSWEAR", "OFFICE SUPPLIES", "OPTICAL - FRAMES", "OPTICAL - LENSES", "PERSONAL CARE",
        "PETS AND SUPPLIES", "PHARMACY OTC", "PHARMACY RX", "PLUS AND MATERNITY",
        "PRE PACKED DELI", "PRODUCE", "SEAFOOD", "SERVICE DELI", "SHEER HOSIERY", "SHOES",
        "SLEEPWEAR/FOUNDATIONS", "SWIMWEAR/OUTERWEAR",
    ],
    "Sin": ["CANDY, TOBACCO, COOKIES", "IMPULSE MERCHANDISE", "LIQUOR,WINE,BEER"],
}
