"""Fixed values of the benchmark schema.

These lists must equal the benchmark's own value lists for query parameters
to select the same rows; they are stated here in their natural order.
"""

# --- fixed values: ship modes ---
SHIP_MODES = ["REG AIR", "AIR", "RAIL", "TRUCK", "MAIL", "FOB", "SHIP"]

# --- fixed values: shipping instructions ---
SHIP_INSTRUCTIONS = ["DELIVER IN PERSON", "COLLECT COD", "TAKE BACK RETURN", "NONE"]

# --- fixed values: part containers ---
CONTAINERS = [
    "SM CASE", "SM BOX", "SM BAG", "SM JAR", "SM PACK", "SM PKG", "SM CAN", "SM DRUM",
    "LG CASE", "LG BOX", "LG BAG", "LG JAR", "LG PACK", "LG PKG", "LG CAN", "LG DRUM",
    "MED CASE", "MED BOX", "MED BAG", "MED JAR", "MED PACK", "MED PKG", "MED CAN", "MED DRUM",
    "JUMBO CASE", "JUMBO BOX", "JUMBO BAG", "JUMBO JAR", "JUMBO PACK", "JUMBO PKG", "JUMBO CAN", "JUMBO DRUM",
    "WRAP CASE", "WRAP BOX", "WRAP BAG", "WRAP JAR", "WRAP PACK", "WRAP PKG", "WRAP CAN", "WRAP DRUM",
]

# --- fixed values: row caps of the top-k queries ---
TOP_K = {"q02": 100, "q03": 10, "q10": 20, "q18": 100, "q21": 100}

# Row counts fixed by the schema definition (not by scale): these two
# dimensions may be broadcast once the bound has been checked on the data.
BOUNDED_ROWS = {"region": 5, "nation": 25}

# Suppliers per scale unit; the scale factor of a data set is
# count(supplier) / SUPPLIERS_PER_SF.
SUPPLIERS_PER_SF = 10000
