"""License scan: ordered signature rules with keyword gates, priorities and containment, in DataFrame functions only.

A rule has two keywords, a regex, a label, a priority and a confidence. A text is searched with a rule only
if it has both keywords, and looked at rule by rule only if it has one of a few words (``GATES``) or speaks of
something licensed, released, … under terms (``UNDER_GATE``). Space between words may hold the mark of a comment line.
All places where a rule matches become detections. One that lies inside another of the same or a higher
priority is suppressed; at equal extent the earlier rule stays. Everything happens within the row, so
nothing is shuffled; suppression is one pass over a document's detections in order of their start.

Defined cases: a null text is empty; an empty text has no detections; whole texts are searched; a regex
finds its places from left to right, without overlap; positions are code points from 0, ends are exclusive;
equal rows get equal results; an empty table gives no rows; columns of the input are carried, and
``detections`` replaces one of that name.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mediaspark.llm.common import fresh

#: Words are runs of ASCII letters, digits and anything outside ASCII.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
BREAK = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"

TAG, NOTICE, ADDRESS, NAME, HINT = 4, 4, 3, 2, 1
CONFIDENCE = {"tag": 1.0, "notice": 0.98, "address": 0.95, "name": 0.9, "hint": 0.5}

# Signatures: label, a keyword of the name, its regex, identifiers in tags (regex), part of the address (regex or none).
# "_" stands for space between words.
SIGNATURES = (
    ("mit", "mit", r"mit_licen[cs]e", r"mit", r"opensource\.org/licenses?/mit"),
    ("mit-0", "mit", r"mit-0|mit_no_attribution", r"mit-0", None),
    ("apache-2.0", "apache", r"apache_licen[cs]e,?_(?:version_)?2(?:\.0)?", r"apache-2\.0", r"apache\.org/licenses/license-2\.0"),
    ("apache-1.1", "apache", r"apache_(?:software_)?licen[cs]e,?_(?:version_)?1\.1", r"apache-1\.1", r"apache\.org/licenses/license-1\.1"),
    ("apache-1.0", "apache", r"apache_(?:software_)?licen[cs]e,?_(?:version_)?1\.0", r"apache-1\.0", r"apache\.org/licenses/license-1\.0"),
    ("apache", "apache", r"apache_(?:software_)?licen[cs]e", r"apache", r"apache\.org/licenses"),
    ("gpl-3.0", "general", r"(?:gnu_)?general_public_licen[cs]e,?_(?:version_|v\.?_?)3(?:\.0)?", r"gpl-3\.0(?:-only|-or-later|\+)?", r"gnu\.org/licenses/gpl-3\.0"),
    ("gpl-2.0", "general", r"(?:gnu_)?general_public_licen[cs]e,?_(?:version_|v\.?_?)2(?:\.0)?", r"gpl-2\.0(?:-only|-or-later|\+)?", r"gnu\.org/licenses/(?:old-licenses/)?gpl-2\.0"),
    ("gpl-1.0", "general", r"(?:gnu_)?general_public_licen[cs]e,?_(?:version_|v\.?_?)1(?:\.0)?", r"gpl-1\.0(?:-only|-or-later|\+)?", None),
    ("gpl-3.0", "gpl", r"gpl[- ]?v?\.?_?3(?:\.0)?", r"gplv3", None),
    ("gpl-2.0", "gpl", r"gpl[- ]?v?\.?_?2(?:\.0)?", r"gplv2", None),
    ("gpl", "general", r"(?:gnu_)?general_public_licen[cs]e", r"gpl", r"gnu\.org/(?:licenses|copyleft)/gpl"),
    ("lgpl-3.0", "lesser", r"(?:gnu_)?lesser_general_public_licen[cs]e,?_(?:version_|v\.?_?)3(?:\.0)?", r"lgpl-3\.0(?:-only|-or-later|\+)?", r"gnu\.org/licenses/lgpl-3\.0"),
    ("lgpl-2.1", "lesser", r"(?:gnu_)?lesser_general_public_licen[cs]e,?_(?:version_|v\.?_?)2\.1", r"lgpl-2\.1(?:-only|-or-later|\+)?", r"gnu\.org/licenses/(?:old-licenses/)?lgpl-2\.1"),
    ("lgpl-2.0", "library", r"(?:gnu_)?library_general_public_licen[cs]e(?:,?_(?:version_|v\.?_?)2(?:\.0)?)?", r"lgpl-2\.0(?:-only|-or-later|\+)?", None),
    ("lgpl", "lesser", r"(?:gnu_)?lesser_general_public_licen[cs]e", r"lgpl", r"gnu\.org/(?:licenses|copyleft)/(?:lgpl|lesser)"),
    ("agpl-3.0", "affero", r"(?:gnu_)?affero_general_public_licen[cs]e,?_(?:version_|v\.?_?)3(?:\.0)?", r"agpl-3\.0(?:-only|-or-later|\+)?", r"gnu\.org/licenses/agpl-3\.0"),
    ("agpl", "affero", r"(?:gnu_)?affero_general_public_licen[cs]e", r"agpl", r"gnu\.org/licenses/agpl"),
    ("gfdl-1.3", "documentation", r"(?:gnu_)?free_documentation_licen[cs]e,?_(?:version_|v\.?_?)1\.3", r"gfdl-1\.3(?:-only|-or-later)?", r"gnu\.org/licenses/fdl-1\.3"),
    ("gfdl-1.2", "documentation", r"(?:gnu_)?free_documentation_licen[cs]e,?_(?:version_|v\.?_?)1\.2", r"gfdl-1\.2(?:-only|-or-later)?", None),
    ("gfdl", "documentation", r"(?:gnu_)?free_documentation_licen[cs]e", r"gfdl", r"gnu\.org/(?:licenses|copyleft)/fdl"),
    ("bsd-2-clause", "bsd", r"(?:bsd_2[- ]clause|2[- ]clause_bsd|simplified_bsd|freebsd)_licen[cs]e", r"bsd-2-clause", r"opensource\.org/licenses?/bsd-2-clause"),
    ("bsd-3-clause", "bsd", r"(?:bsd_3[- ]clause|3[- ]clause_bsd|(?:new|modified|revised)_bsd)_licen[cs]e", r"bsd-3-clause", r"opensource\.org/licenses?/bsd-3-clause"),
    ("bsd-4-clause", "bsd", r"(?:bsd_4[- ]clause|4[- ]clause_bsd|original_bsd)_licen[cs]e", r"bsd-4-clause", None),
    ("0bsd", "bsd", r"(?:zero[- ]clause_bsd|0bsd|bsd_zero[- ]clause)_licen[cs]e", r"0bsd", r"opensource\.org/licenses?/0bsd"),
    ("bsd", "bsd", r"bsd(?:[- ]style)?_licen[cs]e", r"bsd", r"opensource\.org/licenses?/bsd-license"),
    ("isc", "isc", r"isc_licen[cs]e", r"isc", r"opensource\.org/licenses?/isc"),
    ("mpl-2.0", "mozilla", r"mozilla_public_licen[cs]e,?_(?:version_|v\.?_?)?2(?:\.0)?", r"mpl-2\.0", r"mozilla\.org/(?:en-us/)?mpl/2\.0"),
    ("mpl-1.1", "mozilla", r"mozilla_public_licen[cs]e,?_(?:version_|v\.?_?)?1\.1", r"mpl-1\.1", r"mozilla\.org/mpl/mpl-1\.1"),
    ("mpl", "mozilla", r"mozilla_public_licen[cs]e", r"mpl", r"mozilla\.org/(?:en-us/)?mpl"),
    ("epl-2.0", "eclipse", r"eclipse_public_licen[cs]e,?_(?:-_)?(?:version_|v\.?_?)?2(?:\.0)?", r"epl-2\.0", r"eclipse\.org/legal/epl-(?:2\.0|v20)"),
    ("epl-1.0", "eclipse", r"eclipse_public_licen[cs]e,?_(?:-_)?(?:version_|v\.?_?)?1(?:\.0)?", r"epl-1\.0", r"eclipse\.org/legal/epl-v10"),
    ("epl", "eclipse", r"eclipse_public_licen[cs]e", r"epl", r"eclipse\.org/legal/epl"),
    ("edl-1.0", "eclipse", r"eclipse_distribution_licen[cs]e", r"edl-1\.0", r"eclipse\.org/org/documents/edl"),
    ("cddl-1.1", "development", r"common_development_and_distribution_licen[cs]e,?_(?:version_|v\.?_?)?1\.1", r"cddl-1\.1", None),
    ("cddl-1.0", "development", r"common_development_and_distribution_licen[cs]e(?:,?_(?:version_|v\.?_?)?1\.0)?", r"cddl-1\.0", r"opensource\.org/licenses?/cddl"),
    ("cpl-1.0", "common", r"common_public_licen[cs]e(?:,?_(?:version_|v\.?_?)?1\.0)?", r"cpl-1\.0", r"opensource\.org/licenses?/cpl"),
    ("ms-pl", "microsoft", r"microsoft_public_licen[cs]e", r"ms-pl", r"opensource\.org/licenses?/ms-pl"),
    ("ms-rl", "microsoft", r"microsoft_reciprocal_licen[cs]e", r"ms-rl", r"opensource\.org/licenses?/ms-rl"),
    ("artistic-2.0", "artistic", r"artistic_licen[cs]e,?_(?:version_|v\.?_?)?2(?:\.0)?", r"artistic-2\.0", r"opensource\.org/licenses?/artistic-license-2\.0"),
    ("artistic-1.0", "artistic", r"artistic_licen[cs]e(?:,?_(?:version_|v\.?_?)?1\.0)?", r"artistic-1\.0", None),
    ("zlib", "zlib", r"zlib(?:/libpng)?_licen[cs]e", r"zlib", r"opensource\.org/licenses?/zlib"),
    ("libpng", "libpng", r"libpng_licen[cs]e", r"libpng(?:-2\.0)?", None),
    ("bsl-1.0", "boost", r"boost_software_licen[cs]e(?:,?_(?:version_|v\.?_?)?1\.0)?", r"bsl-1\.0", r"boost\.org/license.1.0"),
    ("busl-1.1", "business", r"business_source_licen[cs]e(?:,?_(?:version_|v\.?_?)?1\.1)?", r"busl-1\.1", r"mariadb\.com/bsl11"),
    ("sspl-1.0", "server", r"server_side_public_licen[cs]e", r"sspl-1\.0", r"mongodb\.com/licensing/server-side-public-license"),
    ("elastic-2.0", "elastic", r"elastic_licen[cs]e(?:,?_(?:version_|v\.?_?)?2(?:\.0)?)?", r"elastic-2\.0", r"elastic\.co/licensing/elastic-license"),
    ("eupl-1.2", "european", r"european_union_public_licen[cs]e(?:,?_(?:version_|v\.?_?)?1\.2)?", r"eupl-1\.2", r"joinup\.ec\.europa\.eu/collection/eupl"),
    ("eupl-1.1", "european", r"european_union_public_licen[cs]e,?_(?:version_|v\.?_?)?1\.1", r"eupl-1\.1", None),
    ("cecill-2.1", "cecill", r"cecill(?:[- ]?(?:b|c|2\.1))?_(?:free_software_)?licen[cs]e", r"cecill-(?:2\.1|b|c)", r"cecill\.info/licences"),
    ("unlicense", "unlicense", r"(?:the_)?unlicense", r"unlicense", r"unlicense\.org"),
    ("wtfpl", "wtfpl", r"wtfpl", r"wtfpl", r"wtfpl\.net"),
    ("python-2.0", "python", r"python(?:_software_foundation)?_licen[cs]e(?:_(?:version_)?2(?:\.0)?)?", r"(?:python|psf)-2\.0", r"python\.org/(?:psf|\d\.\d/)license"),
    ("php-3.01", "php", r"php_licen[cs]e(?:,?_(?:version_|v\.?_?)?3\.01)?", r"php-3\.01", r"php\.net/license"),
    ("ruby", "ruby", r"ruby_licen[cs]e", r"ruby", None),
    ("openssl", "openssl", r"openssl_licen[cs]e", r"openssl", r"openssl\.org/source/license"),
    ("ofl-1.1", "font", r"sil_open_font_licen[cs]e(?:,?_(?:version_|v\.?_?)?1\.1)?|open_font_licen[cs]e", r"ofl-1\.1", r"(?:scripts\.sil\.org|openfontlicense\.org)"),
    ("osl-3.0", "open", r"open_software_licen[cs]e(?:,?_(?:version_|v\.?_?)?3(?:\.0)?)?", r"osl-3\.0", r"opensource\.org/licenses?/osl-3\.0"),
    ("afl-3.0", "academic", r"academic_free_licen[cs]e(?:,?_(?:version_|v\.?_?)?3(?:\.0)?)?", r"afl-3\.0", r"opensource\.org/licenses?/afl-3\.0"),
    ("upl-1.0", "universal", r"universal_permissive_licen[cs]e(?:,?_(?:version_|v\.?_?)?1\.0)?", r"upl-1\.0", None),
    ("ncsa", "illinois", r"university_of_illinois(?:/ncsa)?(?:_open_source)?_licen[cs]e", r"ncsa", r"opensource\.org/licenses?/ncsa"),
    ("w3c", "w3c", r"w3c_(?:software_notice_and_|document_)?licen[cs]e", r"w3c", r"w3\.org/consortium/legal"),
    ("odbl-1.0", "database", r"open_(?:data_commons_open_)?database_licen[cs]e", r"odbl-1\.0", r"opendatacommons\.org/licenses/odbl"),
    ("odc-by-1.0", "commons", r"open_data_commons_attribution_licen[cs]e", r"odc-by-1\.0", r"opendatacommons\.org/licenses/by"),
    ("pddl-1.0", "dedication", r"public_domain_dedication_and_licen[cs]e", r"pddl-1\.0", r"opendatacommons\.org/licenses/pddl"),
    ("openrail", "rail", r"(?:creativeml_|bigscience_)?(?:open_?)?rail(?:[- ]?(?:m|\+\+))?_licen[cs]e", r"openrail(?:\+\+|-m)?", r"bigscience\.huggingface\.co/blog/the-bigscience-rail-license"),
    ("cc0-1.0", "cc0", r"cc0(?:[- ]1\.0)?(?:_universal)?", r"cc0-1\.0", r"creativecommons\.org/publicdomain/zero/1\.0"),
    ("cc-pdm-1.0", "domain", r"public_domain_mark(?:_1\.0)?", r"cc-pdm-1\.0", r"creativecommons\.org/publicdomain/mark/1\.0"),
)

#: The six licenses of one family differ in their clauses, spelt out and short, and exist in these versions.
CLAUSES = (("by", "attribution"), ("by-sa", "attribution[- ]share_?alike"), ("by-nc", "attribution[- ]non_?commercial"),
           ("by-nd", "attribution[- ]no_?derivatives"), ("by-nc-sa", "attribution[- ]non_?commercial[- ]share_?alike"),
           ("by-nc-nd", "attribution[- ]non_?commercial[- ]no_?derivatives"))
VERSIONS = ("4.0", "3.0", "2.5", "2.0", "1.0")

# Phrases that speak of terms without naming a license: label, keyword, regex.
HINTS = (
    ("all-rights-reserved", "reserved", r"all_rights_reserved"),
    ("copyright-notice", "copyright", r"copyright_(?:\(c\)|©|[12][0-9]{3})"),
    ("public-domain", "domain", r"(?:released|dedicated|placed)_(?:in)?to_the_public_domain"),
    ("mit-grant", "permission", r"permission_is_hereby_granted,_free_of_charge"),
    ("isc-grant", "permission", r"permission_to_use,_copy,_modify,_and(?:/or)?_distribute_this_software"),
    ("bsd-grant", "redistribution", r"redistribution_and_use_in_source_and_binary_forms"),
    ("no-warranty", "warrant", r"provided_[\"“]?as_is[\"”]?,?_without_(?:any_)?warrant(?:y|ies)"),
    ("licensed", "licensed", r"licensed_under"),
    ("proprietary", "proprietary", r"proprietary_and_confidential"),
    ("non-commercial", "commercial", r"for_non[- ]?commercial_(?:use|purposes)_only"),
)

#: Short names, which speak of a license only where the words around them do: label, keyword, regex.
LATER = r"(?:\+|-only|-or-later|_or_(?:any_)?(?:later|newer)(?:_version)?|,?_or_\(at_your_option\)_any_later_version)?"
SHORT = (
    ("mit", "mit", r"(?:the_)?mit(?:/x11)?(?!-0)"),
    ("mit", "expat", r"(?:the_)?expat"),
    ("apache-2.0", "apache", r"(?:the_)?(?:asl|apache)(?:_licen[cs]e)?[-,]?\s?(?:version_|v\.?\s?)?2(?:\.0)?(?!\.?\d)"),
    ("apache-1.1", "apache", r"(?:the_)?apache[-,]?\s?(?:version_|v\.?\s?)?1\.1"),
    ("bsd-2-clause", "bsd", r"(?:the_)?(?:bsd[- ]2(?:[- ]clause)?|2[- ]clause_bsd|simplified_bsd|freebsd)"),
    ("bsd-3-clause", "bsd", r"(?:the_)?(?:bsd[- ]3(?:[- ]clause)?|3[- ]clause_bsd|(?:new|modified|revised)_bsd)"),
    ("bsd", "bsd", r"(?:the_)?bsd(?![- ][0-9])"),
    ("isc", "isc", r"(?:the_)?isc"),
    ("gpl-3.0", "gpl", r"(?:the_)?(?:gnu_)?gpl[-,]?\s?(?:version_|v\.?\s?)?3(?:\.0)?(?!\.?\d)" + LATER),
    ("gpl-2.0", "gpl", r"(?:the_)?(?:gnu_)?gpl[-,]?\s?(?:version_|v\.?\s?)?2(?:\.0)?(?!\.?\d)" + LATER),
    ("gpl", "gpl", r"(?:the_)?(?:gnu_)?gpl(?![-,]?\s?(?:version|v\.?)?\s?[0-9])"),
    ("lgpl-3.0", "lgpl", r"(?:the_)?(?:gnu_)?lgpl[-,]?\s?(?:version_|v\.?\s?)?3(?:\.0)?(?!\.?\d)" + LATER),
    ("lgpl-2.1", "lgpl", r"(?:the_)?(?:gnu_)?lgpl[-,]?\s?(?:version_|v\.?\s?)?2\.1" + LATER),
    ("lgpl", "lgpl", r"(?:the_)?(?:gnu_)?lgpl(?![-,]?\s?(?:version|v\.?)?\s?[0-9])"),
    ("agpl-3.0", "agpl", r"(?:the_)?(?:gnu_)?agpl[-,]?\s?(?:version_|v\.?\s?)?3(?:\.0)?(?!\.?\d)" + LATER),
    ("agpl", "agpl", r"(?:the_)?(?:gnu_)?agpl(?![-,]?\s?(?:version|v\.?)?\s?[0-9])"),
    ("mpl-2.0", "mpl", r"(?:the_)?mpl[-,]?\s?(?:version_|v\.?\s?)?2(?:\.0)?"),
    ("mpl-1.1", "mpl", r"(?:the_)?mpl[-,]?\s?(?:version_|v\.?\s?)?1\.1"),
    ("epl-2.0", "epl", r"(?:the_)?epl[-,]?\s?(?:version_|v\.?\s?)?2(?:\.0)?"),
    ("epl-1.0", "epl", r"(?:the_)?epl[-,]?\s?(?:version_|v\.?\s?)?1(?:\.0)?"),
    ("bsl-1.0", "boost", r"(?:the_)?boost(?:_1\.0)?"),
    ("zlib", "zlib", r"(?:the_)?zlib(?:/libpng)?"),
    ("unlicense", "unlicense", r"(?:the_)?unlicense"),
    ("cc0-1.0", "cc0", r"(?:the_)?cc0(?:[- ]1\.0)?"),
    ("wtfpl", "wtfpl", r"(?:the_)?wtfpl"),
)
#: Short names that name a version, so that they need no words around them.
CLEAR = {"apache-2.0", "bsd-2-clause", "bsd-3-clause", "gpl-3.0", "gpl-2.0", "lgpl-3.0", "lgpl-2.1", "agpl-3.0"}

#: What may stand before "or MIT": a keyword and how the other name ends.
ALTERNATIVES = (("apache", ("apache", r"apache-2\.0", r"apache 2\.0")), ("bsd", ("bsd", "clause")), ("gpl", ("gpl", "gplv2", "gplv3", r"gpl-2\.0", r"gpl-3\.0")))

#: Passages of the licenses themselves and of their standard notices: label, two keywords, regex.
PUBLISHED = r"_as_published_by_the_free_software_foundation[;,:]?_(?:either_)?(?:under_)?version_"
BODIES = (
    ("mit", "permission", "associated documentation", r"permission_is_hereby_granted,_free_of_charge,_to_any_person_obtaining_a_copy_of_this_software_and_associated_documentation_files"),
    ("mit", "sublicense", "merge", r"to_use,_copy,_modify,_merge,_publish,_distribute,_sublicense,_and/or_sell_copies_of_the_software"),
    ("isc", "permission", "fee", r"permission_to_use,_copy,_modify,_and(?:/or)?_distribute_this_software_for_any_purpose_with_or_without_fee_is_hereby_granted,_provided"),
    ("0bsd", "permission", "fee", r"permission_to_use,_copy,_modify,_and(?:/or)?_distribute_this_software_for_any_purpose_with_or_without_fee_is_hereby_granted\."),
    ("bsd-2-clause", "redistribution", "materials", r"documentation_and/or_other_materials_provided_with_the_distribution\._this_software_is_provided"),
    ("bsd-3-clause", "redistribution", "endorse", r"neither_the_names?_of_(?:\S+\s+){1,12}?may_be_used_to_endorse_or_promote_products"),
    ("bsd-4-clause", "redistribution", "advertising", r"all_advertising_materials_mentioning_features_or_use_of_this_software_must_display"),
    ("zlib", "permission", "altered", r"altered_source_versions_must_be_plainly_marked_as_such,_and_must_not_be_misrepresented"),
    ("bsl-1.0", "permission", "machine-executable", r"machine-executable_object_code_generated_by_a_source_language_processor"),
    ("unlicense", "domain", "unencumbered", r"this_is_free_and_unencumbered_software_released_into_the_public_domain"),
    ("cc0-1.0", "domain", "affirmer", r"affirmer_hereby_overtly,_fully,_permanently,_irrevocably_and_unconditionally_waives"),
    ("apache-2.0", "licen", "reproduction", r"terms_and_conditions_for_use,_reproduction,_and_distribution"),
    ("apache-2.0", "licen", "compliance", r"licensed_under_the_apache_licen[cs]e,_version_2\.0_\(the_[\"“]licen[cs]e[\"”]\);?_you_may_not_use_this_file_except_in_compliance"),
    ("mpl-2.0", "licen", "source code form", r"this_source_code_form_is_subject_to_the_terms_of_the_mozilla_public_licen[cs]e,_v\._2\.0"),
    ("gpl-3.0", "licen", "published", r"general_public_licen[cs]e" + PUBLISHED + r"3"),
    ("gpl-2.0", "licen", "published", r"general_public_licen[cs]e" + PUBLISHED + r"2(?!\.1)"),
    ("lgpl-3.0", "licen", "lesser", r"lesser_general_public_licen[cs]e" + PUBLISHED + r"3"),
    ("lgpl-2.1", "licen", "lesser", r"lesser_general_public_licen[cs]e" + PUBLISHED + r"2\.1"),
    ("agpl-3.0", "licen", "affero", r"affero_general_public_licen[cs]e" + PUBLISHED + r"3"),
    ("gpl-3.0", "licen", "29 june", r"gnu_general_public_licen[cs]e_version_3,_29_june_2007"),
    ("gpl-2.0", "licen", "june 1991", r"gnu_general_public_licen[cs]e_version_2,_june_1991"),
    ("lgpl-2.1", "licen", "february 1999", r"gnu_lesser_general_public_licen[cs]e_version_2\.1,_february_1999"),
    ("lgpl-3.0", "licen", "29 june", r"gnu_lesser_general_public_licen[cs]e_version_3,_29_june_2007"),
    ("agpl-3.0", "licen", "november 2007", r"gnu_affero_general_public_licen[cs]e_version_3,_19_november_2007"),
    ("ofl-1.1", "licen", "font", r"this_font_software_is_licensed_under_the_sil_open_font_licen[cs]e"),
    ("artistic-2.0", "licen", "artistic", r"the_artistic_licen[cs]e_2\.0_copyright"),
)

#: A text that any rule matches has one of these; a text without any is not looked at further.
GATES = ("licen", "spdx", "copyright", "reserved", "domain", "permission", "redistribution", "warrant", "gpl", "cc by", "cc-by", "cc0",
         "attribution", "://", "wtfpl", "proprietary", "commercial", "mit-0", "apache", "bsd")

#: Space between words; a line of a comment may begin in it.
SPACE = r"(?:\s+(?:[*#/;%|-]{1,3}\s+)?)"
GIVEN = r"(?:licen[cs]ed|released|distributed|available|published|provided|issued|offered|shared)"
#: As are the rules about something that is given under terms, which need no other word.
UNDER_GATE = f"{GIVEN}{SPACE}under|under{SPACE}the{SPACE}terms"


@dataclass(frozen=True)
class Rule:
    order: int
    label: str
    first: str
    second: str
    regex: str
    priority: int
    confidence: float


def written(name: str) -> str:
    return r"(?i)(?<![a-z0-9])(?:" + name.replace("_", SPACE) + r")(?![a-z0-9])"


def rules() -> tuple[Rule, ...]:
    """All rules in order; for each signature a tag, a notice, an address and the bare name."""
    found: list[tuple] = []
    under = GIVEN + r"_under_(?:the_)?(?:terms_(?:and_conditions_)?of_)?(?:either_)?(?:the_)?(?:gnu_)?"

    def signature(label, keyword, name, tag, address):
        gate = "cc" if keyword == "cc" else "licen" if "licen" in name else next((g for g in GATES if g in keyword), keyword)
        found.append((label, "spdx", "identifier", rf"spdx-license-identifier:\s*\(*{tag}(?![-.\w])", TAG, "tag"))
        found.append((label, "spdx", keyword if keyword in tag else "spdx", rf"(?:and|or)_\(*{tag}(?![-.\w])", TAG, "tag"))
        found.append((label, "under", keyword, rf"{under}(?:{name})", NOTICE, "notice"))
        host, slash, path = address.partition("/") if address else ("", "", "")
        for one in host.removeprefix("(?:").removesuffix(")").split("|") if host else ():
            found.append((label, "://", one.replace("\\", ""), rf"https?://(?:www\.)?{one}{slash}{path}", ADDRESS, "address"))
        found.append((label, gate, keyword, name, NAME, "name"))

    for entry in SIGNATURES:
        signature(*entry)
    for clauses, long in CLAUSES:
        short = clauses.replace("-", "[- ]")
        for version in VERSIONS:
            dotted = version.replace(".", r"\.")
            label = f"cc-{clauses}-{version}"
            signature(label, "cc", rf"cc[- ]{short}[- ]{dotted}", rf"cc-{clauses}-{dotted}", rf"creativecommons\.org/licenses/{clauses}/{dotted}")
            found.append((label, "creative", "attribution", rf"creative_commons_{long}_(?:licen[cs]e_)?(?:version_|v)?{dotted}", NAME, "name"))
        found.append((f"cc-{clauses}", "creative", "attribution", rf"creative_commons_{long}", NAME, "name"))
    for label, first, second, regex in BODIES:
        found.append((label, first, second, regex, NOTICE, "notice"))
    for label, keyword, short in SHORT:
        found.append((label, "under", keyword, rf"{under}{short}", NOTICE, "notice"))
        found.append((label, "terms", keyword, rf"under_the_terms_(?:and_conditions_)?of_{short}", NOTICE, "notice"))
        found.append((label, "licen", keyword, rf"licen[cs]e(?:s|_type)?[\"']?\s*[:=]\s*[\"'\[(]*{short}", NOTICE, "notice"))
        found.append((label, "licen", keyword, rf"licen[cs]ed(?:_(?:under|as|with|by))?:?_(?:either_)?{short}", NOTICE, "notice"))
        found.append((label, "licen", keyword, rf"{short}[- ]licen[cs]ed", NOTICE, "notice"))
        found.append((label, "licen", keyword, rf"badge/licen[cs]e-{short}", ADDRESS, "address"))
        if label in CLEAR:
            found.append((label, next(g for g in GATES if g in keyword), keyword, short, NAME, "name"))
    for other, ends in ALTERNATIVES:
        before = "|".join(f"(?<={end}{joined})" for end in ends for joined in ("/", " / ", r"\|", " or ", " and "))
        found.append(("mit", other, "mit", rf"(?:{before})mit", NAME, "name"))
    for label, keyword, regex in HINTS:
        found.append((label, keyword, keyword, regex, HINT, "hint"))
    return tuple(Rule(i, f[0], f[1], f[2], written(f[3]), f[4], CONFIDENCE[f[5]]) for i, f in enumerate(found))


def _literal(chosen: tuple[Rule, ...]) -> Column:
    return F.array(*(
        F.struct(
            F.lit(r.order).alias("rule"), F.lit(r.label).alias("label"), F.lit(r.first).alias("first"), F.lit(r.second).alias("second"),
            F.lit(r.regex).alias("regex"), F.lit(r.priority).alias("priority"), F.lit(r.confidence).alias("confidence"),
        )
        for r in chosen
    ))


def pieces_of(text: Column, regex: Column) -> Column:
    """What lies before, between and after the places where the regex matches."""
    return F.split(text, regex, -1)


def _places(text: Column, rule: Column) -> Column:
    """Detections of one rule: positions are sums of the lengths that lie before."""
    pieces = pieces_of(text, rule["regex"])
    matches = F.regexp_extract_all(text, rule["regex"], F.lit(0))
    none = F.array().cast(DETECTIONS)
    walked = F.aggregate(
        F.arrays_zip(matches.alias("match"), F.slice(pieces, F.lit(1), F.size(matches)).alias("before")),
        F.struct(F.lit(0).alias("at"), none.alias("found")),
        lambda state, x: F.struct(
            (state["at"] + F.char_length(x["before"]) + F.char_length(x["match"])).alias("at"),
            F.concat(
                state["found"],
                F.array(
                    F.struct(
                        (state["at"] + F.char_length(x["before"])).alias("start"),
                        F.negative(state["at"] + F.char_length(x["before"]) + F.char_length(x["match"])).alias("minus_end"),
                        F.negative(rule["priority"]).alias("minus_priority"),
                        rule["rule"].alias("rule"),
                        rule["label"].alias("label"),
                        rule["confidence"].alias("confidence"),
                    )
                ),
            ).alias("found"),
        ),
    )
    return walked["found"]


DETECTIONS = "array<struct<start:int,minus_end:int,minus_priority:int,rule:int,label:string,confidence:double>>"
TIERS = (HINT, NAME, ADDRESS, NOTICE)


def _unsuppressed(found: Column) -> Column:
    """One pass over detections by start, then the longest, the highest priority, the first rule.

    ``reach`` has, for each tier, how far detections of that or a higher priority reached so far: whatever
    ends within the reach of its own tier lies inside one that came before.
    """
    reach = F.array(*(F.lit(-1) for _ in TIERS))

    def step(state, d):
        tier = F.array_position(F.lit(list(TIERS)), -d["minus_priority"]).cast("int")
        end = -d["minus_end"]
        inside = F.element_at(state["reach"], tier) >= end
        wider = F.transform(state["reach"], lambda r, i: F.when(i < tier, F.greatest(r, end)).otherwise(r))
        return F.struct(
            F.when(inside, state["reach"]).otherwise(wider).alias("reach"),
            F.when(inside, state["kept"]).otherwise(F.concat(state["kept"], F.array(d))).alias("kept"),
        )

    return F.aggregate(F.array_sort(found), F.struct(reach.alias("reach"), F.array().cast(DETECTIONS).alias("kept")), step)["kept"]


def scan(docs: DataFrame, text: str = "text", chosen: tuple[Rule, ...] | None = None) -> DataFrame:
    """Adds ``detections``: start, end, label, priority, rule and confidence of each that is not suppressed."""
    body, low, found_here = (fresh(docs, name) for name in ("body", "low", "found_here"))
    chosen = rules() if chosen is None else chosen
    staged = docs.withColumn(body, F.coalesce(F.col(text), F.lit(""))).withColumn(low, F.lower(body))
    worth = F.lit(False)
    for gate in GATES:
        worth = worth | F.contains(F.col(low), F.lit(gate))
    worth = worth | (F.contains(F.col(low), F.lit("under")) & F.rlike(F.col(low), F.lit(UNDER_GATE)))
    candidates = F.filter(_literal(chosen), lambda r: F.contains(F.col(low), r["first"]) & F.contains(F.col(low), r["second"]))
    found = F.flatten(F.transform(candidates, lambda r: _places(F.col(body), r)))
    kept = F.when(worth, _unsuppressed(found)).otherwise(F.array().cast(DETECTIONS))
    shown = F.transform(
        F.col(found_here),
        lambda d: F.struct(
            d["start"].alias("start"), (-d["minus_end"]).alias("end"), d["label"].alias("label"),
            (-d["minus_priority"]).alias("priority"), d["rule"].alias("rule"), d["confidence"].alias("confidence"),
        ),
    )
    return staged.withColumn(found_here, kept).withColumn("detections", shown).drop(body, low, found_here)
