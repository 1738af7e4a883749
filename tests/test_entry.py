import re

import __spark_entry__ as entry

SURVEY_KEYS = """
scan_reviews_json scan_appstore_feed scan_playstore scan_labelled_reviews scan_themes_csv scan_qa_json
parse_action_items sink_reviews_json sink_themes_csv sink_qa_json sink_notes_text sink_filtered_csv
normalize_reviews clean_reviews coerce_rating parse_dates default_theme display_projection preview_lines
rolling_window_filter drop_unparseable_dates source_precedence facet_filter search_reviews rated_only
pii_marked_rows theme_back_join theme_lexicon_join question_evidence_join dashboard_kpis channel_share
ratings_distribution facet_values source_window_counts theme_volume_severity pii_incident_counts
feed_take_while number_reviews representative_quotes newest_n subsample_head top_themes preview_head
union_sources first_wins_dedupe topup_resample mask_pii assign_themes discover_themes question_evidence
prompt_lines pack_prompts annotate_batches parse_responses explode_payload weekly_note
""".split()
# Rejects, identity, and the same results from other layouts.
BESIDE_KEYS = "reply_quarantine review_identity scan_appstore_feed_rejects landing_window landing_feed search_indexed".split()
ROWS_ONLY = {"discover_themes"}


def test_every_survey_key_is_registered():
    assert len(SURVEY_KEYS) == 56
    keys = set(SURVEY_KEYS) | set(BESIDE_KEYS)
    corpus = {k for k in entry.queries() if re.match(r"op\d+_|pipeline$", k)}
    assert set(entry.queries()) - corpus == keys
    assert set(entry.oracle_sql()) - corpus == keys - ROWS_ONLY


def test_entry_runs(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) == 5
    assert df.columns == ["source", "n_reviews", "avg_rating", "masked_rows", "share"]


def test_no_row_caps_in_registered_sql():
    # A remainder shapes the data there, and every row is read: the layout of
    # the feed (FIXTURES.md), and which batches' replies come fenced or broken.
    shaped = {"feed_take_while", "landing_feed", "parse_responses", "reply_quarantine", "explode_payload", "theme_back_join",
              "scan_themes_csv", "sink_themes_csv"}
    for key, sql in entry.oracle_sql().items():
        if key not in shaped:
            assert not re.search(r"%\s*\d+\s*=|\bmod\(", sql), key
