"""Names, markers, codes and limits that results depend on.

Campaign managers and the ad networks chose these; changing one changes results.
"""

# A campaign belongs to the agency when its cleaned name starts with this prefix.
AGENCY_PREFIX = "realweb"

# Two letters or a word after the prefix name the network: realweb_<code>_...
INSTALL_CODE_PATTERN = r"realweb_([a-z]+)_"
SOURCE_BY_CODE = {
    "fb": "facebook",
    "hw": "huawei",
    "mt": "mytarget",
    "tiktok": "tiktok",
    "uac": "google_ads",
    "vk": "vkontakte",
    "ya": "yandex",
}
UNKNOWN_SOURCE = "other"

# Retargeting campaigns carry one of the words between delimiters.
RETARGETING_WORDS = ("old", "ret")
RETARGETING_PATTERN = r"([\[_]old[\]_])|([\[_]ret[\]_])"

# Platform markers, searched anywhere in the lower-cased name; iOS wins over Android.
IOS_MARKERS = ("[p:ios]", "_ios_", "p02")
ANDROID_MARKERS = ("[p:and]", "_and_", "android", "p01")
IOS = "ios"
ANDROID = "android"
NO_PLATFORM = "no_platform"

# Install time text looks like 2022-05-01 10:11:12.123.
EVENT_TIME_USUAL = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}\.\d{3}\z"
EVENT_DAY_PATTERN = r"([\d-]*)[\t\n\f\r ]"
EVENT_SECOND_PATTERN = r"(?d)(.*)\.\d{3}\z"
DAY_FORMAT = "yyyy-M-d"
SECOND_FORMAT = "yyyy-M-d H:m:s"

# The cost check reports values above this limit.
COST_LIMIT = 5000

# Characters with the Unicode White_Space property.
WHITE_SPACE = "".join(
    map(
        chr,
        [
            *range(0x0009, 0x000E),
            0x0020,
            0x0085,
            0x00A0,
            0x1680,
            *range(0x2000, 0x200B),
            0x2028,
            0x2029,
            0x202F,
            0x205F,
            0x3000,
        ],
    )
)
