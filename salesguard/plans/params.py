"""Parameters of the registered queries (shared by the Spark plans and the oracle).

The reference's own values are the operator defaults; the registered queries
use values that make the filters select something on the test tables
(FIXTURES.md C, "Parameters that make the filters bite").
"""

# Look-back: covers every order of the test tables (1995-01-01 .. 2001-08-01).
AS_OF = "2001-08-01"
DAYS = 2405

# Keyword map thresholds for the test tables (reference: 100 / 10 / 0.1 % / 10 %).
KW_MIN_TOTAL = 20
KW_MIN_PAIR = 2
KW_MIN_SHARE_OF_CATEGORY = 0.1
KW_MIN_SHARE_OF_KEYWORD = 10

# Users whose events don't count (the reference lists staff accounts; these are users of the test tables).
EXCLUDED_USERS = (3, 17, 42)

# Sparse keys at city level (store level marks every key on the test tables).
SPARSE_MIN_CARTS = 3
