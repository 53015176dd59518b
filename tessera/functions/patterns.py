"""Regular-expression building blocks shared by Spark (Java regex) and the
DuckDB oracle (RE2).

Java's ``\\w`` and ``\\s`` are ASCII-only, while the reference's Python
patterns are Unicode-aware.  The classes below reproduce Python's str-mode
``\\s`` and ``\\w`` and are valid in both Java and RE2 syntax.
"""

# --- fixed values (must equal the reference's behaviour) -------------------
# Python str-mode whitespace: \t \n \v \f \r, U+001C..U+001F, space, U+0085,
# and the Unicode separators (Zs, Zl, Zp).
WS = r"[\t-\r\x1c-\x20\x{85}\p{Z}]"
NON_WS = r"[^\t-\r\x1c-\x20\x{85}\p{Z}]"
# Python str-mode word character: letters, numbers, underscore.
WORD = r"[\p{L}\p{N}_]"

# URL and mention patterns of the light tweet normalizer.
URL_PATTERN = rf"http{NON_WS}+|www\.{NON_WS}+"
MENTION_PATTERN = rf"@{WORD}+"
HASHTAG_PATTERN = rf"#({WORD}+)"
# Default word tokenizer of the TF-IDF vectorizer: runs of two or more
# word characters.
TOKEN_PATTERN = rf"{WORD}{{2,}}"
# Whole-token tests of the mention/link preprocessing.
FULL_MENTION = rf"^@{WORD}+$"
LINK_PREFIX = r"(?i)^(https?://|www\.)"
# ----------------------------------------------------------------------------
