"""Schemas of posts, comments and exchange files. A missing field and a null are the same here: NULL."""

from __future__ import annotations

STANCE_DIST = "struct<agree:double,disagree:double,neutral:double>"
SENTIMENT_DIST = "struct<positive:double,negative:double,neutral:double>"
COMMENTS = "comment_id string, post_id string, author string, comment_text string, comment_text_clean string, upvote_score bigint, created_utc bigint, sentiment_label string, stance_label string, llm_confidence double, llm_comment_exp string, weight double, snapshot_week string, created_at timestamp, updated_at timestamp"
POSTS = f"post_id string, subreddit string, title string, selftext string, cleaned_selftext string, topic_text string, is_self boolean, category string, author string, url string, created_utc bigint, score bigint, upvote_ratio double, num_comments bigint, link_flair_text string, snapshot_week string, embedding array<float>, embedding_model string, embedding_dim int, umap_x double, umap_y double, umap_50d array<double>, topic_id string, center_distance double, topic_name string, topic_description string, confidence double, topic_name_rating double, stance_dist_weighted {STANCE_DIST}, sentiment_dist_weighted {SENTIMENT_DIST}, polarization_score double, created_at timestamp, updated_at timestamp"
REQUIRED = {"posts": ["post_id", "subreddit", "created_utc", "snapshot_week"], "comments": ["comment_id", "post_id", "created_utc", "snapshot_week"]}
TERMS_CSV = "topic_id string, post_count int, top_terms string, top_scores string"
CHUNKS_CSV = "topic_id string, chunk_id string, post_count int, near_count int, far_count int, token_estimate int, cluster_token_sum int, ctfidf_terms string"
CHUNK_POSTS_CSV = "topic_id string, chunk_id string, post_index int, tag string, post_id string, distance string, text string"
RESULTS_CSV = "batch_id string, topic_id string, chunk_id string, topic_name string, topic_description string, confidence string, representative_indices string, status string, error string"
EXPORT_JSONL = "post_id string, post_text string, comments array<struct<comment_id:string,comment_text:string>>"
LABELS_JSONL = "post_id string, comment_id string, sentiment string, sentiment_label string, stance string, stance_label string, confidence double, llm_confidence double, rationale string, llm_comment_exp string"
