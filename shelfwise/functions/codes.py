"""Business constants of the library system.

Fixed values (they must equal the source system's codes for right results):

- AVAILABLE_STATUS:  - ! b p ( @ ) _ = +
- ACTIVE_STATUS:     - ! b p ( @ ) _ = + t
- EXCLUDED_STATUS:   $ e f g i l m n s v w y z
- ACTIVE_PTYPES:     0 1 2 5 6 10 11 12 15 22 30 31 32 40 41 196
- ACTIVE_PTYPES_LEGACY (adds 3): 0 1 2 3 5 6 10 11 12 15 22 30 31 32 40 41 196
- leased barcodes:   >= 'L000000000000' and < 'M'
- leased formats:    Leased Book, Leased DVD
- hold status text:  0 on hold; b bib hold ready for pickup; j volume hold ready
  for pickup; i item hold ready for pickup; t in transit to pickup location
- circulation ops:   o checkout, i checkin, f filled hold
"""

AVAILABLE_STATUS = ["-", "!", "b", "p", "(", "@", ")", "_", "=", "+"]
ACTIVE_STATUS = AVAILABLE_STATUS + ["t"]
EXCLUDED_STATUS = ["$", "e", "f", "g", "i", "l", "m", "n", "s", "v", "w", "y", "z"]
ACTIVE_PTYPES = [0, 1, 2, 5, 6, 10, 11, 12, 15, 22, 30, 31, 32, 40, 41, 196]
ACTIVE_PTYPES_LEGACY = [0, 1, 2, 3, 5, 6, 10, 11, 12, 15, 22, 30, 31, 32, 40, 41, 196]
FROZEN_EXEMPT_PTYPE = 196
LEASED_BARCODE_LOW = "L000000000000"
LEASED_BARCODE_HIGH = "M"
LEASED_FORMATS = ["Leased Book", "Leased DVD"]
HOLD_STATUS_TEXT = {
    "0": "on hold",
    "b": "bib hold ready for pickup",
    "j": "volume hold ready for pickup",
    "i": "item hold ready for pickup",
    "t": "in transit to pickup location",
}
CIRC_OPS = ["o", "i", "f"]

# Presentation prefixes are configuration, not logic; override per deployment.
CATALOG_URL_PREFIX = "https://catalog.example.org/Record/"
JACKET_URL_PREFIX = "https://covers.example.org/isbn/"
ITEM_VIEW_URL_PREFIX = "/current_collection/item_view?_facet=location_code&_facet=item_format&location_code__exact="
LOCATION_ITEMS_HREF_PREFIX = "/current_collection/item?location_code__exact="
GENRE_HREF_PREFIX = "/current_collection/bib?genres__arraycontains="
