"""Parameters of the registered queries (shared by Spark plans and oracle)."""

# The bundled events span 15-30 days, so window tests use one week back
# from the newest review.
WEEKS = 1
TOP_K = 3
# The newest rows that the top-n query reports.
NEWEST_N = 600
# Entries of a feed page; reviews with an id divisible by STRAY_EVERY come on a
# page behind all others.
FEED_PAGE_SIZE = 50
STRAY_EVERY = 10
RESAMPLE_RATE, RESAMPLE_SEED = 0.25, 42
QUOTE_K = 3
PACK_SIZE = 35
HEAD_SIZE = 35
FAIR_K = 7
SEARCH_PATTERN = "ver(y|s)|email"
# Characters that the size limit of the measuring call allows.
CONTEXT_CHARS = 48_000
# Of every REPLY_CYCLE batches the reply of one comes fenced, of one as a
# refusal and of one cut off.
REPLY_CYCLE, FENCED_REPLY, REFUSED_REPLY, CUT_REPLY = 6, 2, 3, 4
REFUSAL = "Sorry, I cannot help with that."

# --- fixed values: theme lexicon of the bundled data (FIXTURES F-2) ---
THEME_TERMS = {
    "theme_alpha": ("the", "and", "that"),
    "theme_beta": ("der", "die", "und"),
    "theme_gamma": ("que", "los", "el"),
    "theme_delta": ("le", "les", "une"),
}
THEME_NAMES = {
    "theme_alpha": ("English-language feedback", "Reviews written in English"),
    "theme_beta": ("German-language feedback", "Reviews written in German"),
    "theme_gamma": ("Spanish-language feedback", "Reviews written in Spanish"),
    "theme_delta": ("French-language feedback", "Reviews written in French"),
}
# evidence terms per question for the bundled data
QUESTION_TERMS = {
    "struggle_points": ("is", "was", "are"),
    "ordering_frustrations": ("to", "for", "from"),
    "delivery_partner_and_user_issues": ("with", "by", "at"),
    "switch_causes_and_loyalty_barriers": ("von", "mit", "sich"),
    "discovery_challenges": ("del", "se", "es"),
    "unmet_needs": ("des", "du", "elle"),
}
# --- end of fixed values ---
