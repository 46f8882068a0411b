"""Static dimensions.

FIXED VALUES: these must equal the product definitions for results to be
right. They are stated here once, in natural order, and jobs take them as
arguments with these as defaults.
"""

from __future__ import annotations

# --- fixed values: sign-up report -------------------------------------
# geo.country name -> report country code; anything else (and null) -> Other
SIGNUP_COUNTRY_CODES = [
    ("Vietnam", "VN"),
    ("Indonesia", "ID"),
    ("Malaysia", "MY"),
    ("Saudi Arabia", "SA"),
    ("Thailand", "TH"),
    ("South Korea", "KR"),
]
OTHER_COUNTRY = "Other"
# method names reported as themselves; any other non-null value -> unknown
SIGNUP_METHODS = ["google", "phone", "apple", "facebook", "kakao"]
UNKNOWN_METHOD = "unknown"
# success parameter values (after lower-casing) that count as a success
SUCCESS_VALUES = ["true", "1", "success"]
# event names the cohort report reads
FIRST_OPEN = "first_open"
SIGNUP_RESULT = "signup_result"
# default first day of the report
DEFAULT_START_DATE = "2026-07-10"

# --- fixed values: matrix hand-over -----------------------------------
MATRIX_COUNTRIES = ["VN", "ID", "MY", "SA", "TH", "KR", "Other"]
MATRIX_FIELDS = ["first_opens", "registered", "google", "phone", "apple",
                 "facebook", "kakao", "unknown"]
TOTAL_FIELDS = ["first_opens", "registered", "android_first_opens", "android_registered"]
DEFAULT_METHOD_START = "2026-07-22"
PARTIAL_DAY_MARK = "*"

# --- fixed values: experiment funnel ----------------------------------
EXPERIMENT = "conv_funnel_v1"
ASSIGN_EVENT = "experiment_group_assign"
CHECKOUT_EVENT = "subscription_checkout_start"
LESSON_EVENT = "lesson_event"
GROUPS = ["A", "B"]
FALLBACK_GROUP = "fallback"
# country tabs of the funnel dashboard (plus the "all" tab)
FUNNEL_COUNTRY_CODES = [
    ("South Korea", "KR"),
    ("Saudi Arabia", "SA"),
    ("Malaysia", "MY"),
    ("Indonesia", "ID"),
    ("Vietnam", "VN"),
]
ALL_COUNTRIES = "ALL"
# first-lesson ids per group
LESSONS_A = [732, 1615, 734, 733, 1613, 1614]
LESSONS_B = [1661]
# screens without a named event: (group, screen, the step it follows)
SCREENS = [
    ("B", "study_plan", "signup"),
    ("B", "paywall_1", "study_plan"),
]
# input metrics without a named event
INPUT_SCREENS = ["lesson_finish", "paywall_1", "paywall_2"]
# known tracking gaps: (group, app version, step) usable for diagnosis only
KNOWN_GAPS = [
    ("B", "1.4.2", "study_plan"),
    ("B", "1.4.2", "paywall_1"),
]
SMALL_SAMPLE_MIN = 30
FALLBACK_SHARE_MAX = 0.01
CONFLICT_MAX = 0
ZERO_RUN_HOURS = 6
VERSION_DROP = 0.30
MATURITY_DAYS = 7
ORDER_SUCCESS = "SUCCESS"
PLATFORM = "ANDROID"

# --- fixed values: feedback -------------------------------------------
ANONYMOUS_NAME = "匿名"
MAX_NAME_CHARS = 20
MAX_TEXT_CHARS = 2000
MAX_IMAGES = 9
# characters removed by a browser string trim (code points): tab, line
# feed, vertical tab, form feed, carriage return, space, no-break space,
# ogham space, en quad .. hair space, line separator, paragraph separator,
# narrow no-break space, medium math space, ideographic space, byte order mark
TRIM_CODEPOINTS = [0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20, 0xA0, 0x1680,
                   *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000, 0xFEFF]
TRIM_SET = "".join(chr(c) for c in TRIM_CODEPOINTS)
FEEDBACK_DESTINATIONS = ["pool", "test", "direct", "none"]

# --- fixed values: requirement workflow -------------------------------
POOL_DEFAULT_STATUS = "未启动"
POOL_STATUS_CHAIN = ["未启动", "产品设计中", "待评审", "UI设计中", "排期中", "开发中", "已完成"]
POOL_HANDOFF_STATUS = "排期中"
POOL_DONE_STATUS = "已完成"
RELEASE_STATUS_CHAIN = ["需求沟通中", "PRD编写中", "PRD已评审", "UI设计中", "开发中", "测试中", "已上线"]
RELEASE_HOLD_STATUS = "挂起"
RELEASE_LIVE_STATUS = "已上线"
RELEASE_TYPES = ["产品需求", "紧急Bug", "研发优化", "体验优化"]
PRODUCT_REQUIREMENT = "产品需求"
APP_PRODUCT = "用户端"
BACKEND_VERSION_PATTERN = r"^.+-([0-9]{4}|[0-9]{4}W[0-9]{2})$"
