"""Column -> Column functions; all native Spark expressions."""

from histevents.functions import scalars, text  # noqa: F401
from histevents.functions.scalars import (  # noqa: F401
    digital_root, digital_root_meaning, event_hash, surrogate_id, century,
    pct_change, format_1f, is_valid_url, is_valid_date_string,
    year_batch_start, year_batches, year_from_date_string, published_year,
)
from histevents.functions.text import (  # noqa: F401
    clean_text, first_year, nearest_year, split_sections, split_sentences,
    event_title, extract_location, extract_participants, extract_tags,
    categorize, estimate_severity, news_severity, news_location,
    news_participants, trigrams, trigram_similarity, description_fallback,
)
