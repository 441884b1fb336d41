"""Column layouts of the datasets and of the delimited files, as Spark reads them (DDL text)."""

RAW_EVENT_LOG = "data map<string,array<string>>, log_type string, dt string"
RAW_TRACKER_LOG = "row string, dt string"
BEHAVIOURS = "ad_id string, item_id string, behavior_type int, ts bigint, dt string"
ACTIVE_ITEMS = "item_id string, item_num bigint, item_no bigint, dt string"
ITEM_INDEX = "item_id string, item_no bigint, dt string"
USER_FEATURES = (
    "ad_id string, part int, item_seq string, behavior_seq string, item_car string, "
    "item_purchase string, item_category string, n_items bigint, dt string"
)
USER_SESSIONS = (
    "ad_id string, part int, item_nos array<bigint>, behavior_types array<int>, n_items bigint, "
    "dt string"
)
TRAIN_SAMPLE_TEXT = (
    "ad_id string, item_seq string, behavior_seq string, item_car string, "
    "item_purchase string, item_category string, item_target bigint, label int"
)
TRAIN_SAMPLE = (
    "ad_id string, item_seq string, behavior_seq string, item_car string, "
    "item_purchase string, item_category string, item_target bigint, label int, dt string"
)
TRAIN_EXAMPLE = (
    "ad_id string, item_seq array<bigint>, behavior_seq array<bigint>, item_car array<bigint>, "
    "item_purchase array<bigint>, item_category array<bigint>, item_target bigint, label bigint"
)
IMPRESSIONS = (
    "ots string, ad_id string, creative_id bigint, uuid string, sales_e6 bigint, "
    "postback int, click int, dt string"
)
IMPRESSION_EXTENSION = "ots string, social_welfare double, dt string"
IMPRESSION_ITEMS = "ots string, creative_id bigint, mc_item_id string, dt string"
CREATIVES = "creative_id bigint, merchandise_catalog_id int"
FEATURE_MATERIAL = (
    "ots string, ad_id_plus string, campaign_id string, cf string, cxf string, uf string, "
    "click double, postback double, dt string"
)
USER_BEHAVIOUR_ARRAYS = (
    "ad_id string, part int, content_ids array<string>, behavior_types array<string>, "
    "has_view int, has_add_to_car int, dt string"
)
USER_BEHAVIOUR_JSON = "ad_id string, part int, user_behavior_f string, dt string"
CTR_SAMPLE = (
    "ots string, ad_id_plus string, campaign_id string, item_id string, core_label string, "
    "itemf string, cf string, cxf string, uf string, ctr_label double, cvr_label double, dt string"
)
MERGED_FEATURES = (
    "ots string, ad_id_plus string, campaign_id string, item_id string, core_label string, "
    "features string, ctr_label double, cvr_label double, dt string"
)
USER_ITEM_SCORES = (
    "ad_id string, item_id string, user_index int, item_index int, score double"
)
USER_POSITIVES = "ad_id string, item string"
USER_CATEGORY_SEQUENCES = "ad_id string, item_seq string, category_seq string"
CATEGORY_COUNTS = "item_category string, counts bigint"
