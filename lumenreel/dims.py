"""Small dimensions with fixed values."""

from __future__ import annotations

# Language code, native folder name, English name, further aliases.
LANGUAGES = [
    ("en", "English", "English", []),
    ("vi", "Tiếng Việt", "Vietnamese", ["tieng viet", "tieng-viet"]),
    ("pt", "Português", "Portuguese", ["portugues"]),
    ("es", "Español", "Spanish", ["espanol"]),
    ("fr", "Français", "French", ["francais"]),
    ("de", "Deutsch", "German", []),
    ("it", "Italiano", "Italian", []),
    ("ru", "Русский", "Russian", []),
    ("ja", "日本語", "Japanese", ["nihongo"]),
    ("ko", "한국어", "Korean", ["hangugeo"]),
    ("zh", "中文", "Chinese", ["mandarin", "zhongwen"]),
    ("th", "ไทย", "Thai", []),
    ("id", "Indonesia", "Indonesian", ["bahasa indonesia"]),
    ("ar", "العربية", "Arabic", []),
    ("tr", "Türkçe", "Turkish", ["turkce"]),
    ("hi", "हिन्दी", "Hindi", []),
    ("nl", "Nederlands", "Dutch", []),
    ("pl", "Polski", "Polish", []),
    ("km", "ខ្មែរ", "Khmer", ["cambodian"]),
    ("ml", "മലയാളം", "Malayalam", []),
    ("my", "မြန်မာ", "Burmese", ["myanmar"]),
    ("ne", "नेपाली", "Nepali", []),
    ("sw", "Kiswahili", "Swahili", []),
    ("ta", "தமிழ்", "Tamil", []),
    ("te", "తెలుగు", "Telugu", []),
    ("ur", "اردو", "Urdu", []),
    ("yo", "Yorùbá", "Yoruba", []),
    ("bn", "বাংলা", "Bengali", ["bangla"]),
    ("fa", "فارسی", "Persian", ["farsi"]),
    ("uk", "Українська", "Ukrainian", []),
    ("ms", "Melayu", "Malay", []),
    ("fil", "Filipino", "Filipino", []),
    ("tl", "Tagalog", "Tagalog", []),
    ("sv", "Svenska", "Swedish", []),
    ("no", "Norsk", "Norwegian", ["nb", "nn"]),
    ("da", "Dansk", "Danish", []),
    ("fi", "Suomi", "Finnish", []),
    ("el", "Ελληνικά", "Greek", []),
    ("he", "עברית", "Hebrew", ["iw"]),
    ("cs", "Čeština", "Czech", []),
    ("ro", "Română", "Romanian", []),
    ("hu", "Magyar", "Hungarian", []),
    ("bg", "Български", "Bulgarian", []),
    ("sr", "Српски", "Serbian", []),
    ("hr", "Hrvatski", "Croatian", []),
    ("sk", "Slovenčina", "Slovak", []),
    ("sl", "Slovenščina", "Slovenian", []),
    ("lt", "Lietuvių", "Lithuanian", []),
    ("lv", "Latviešu", "Latvian", []),
    ("et", "Eesti", "Estonian", []),
]

# Country, by code or name, and the region whose music it likes.
COUNTRY_REGIONS = [
    ("US", "anglo"), ("UNITED STATES", "anglo"), ("UK", "anglo"), ("UNITED KINGDOM", "anglo"), ("CA", "anglo"), ("CANADA", "anglo"), ("AU", "anglo"), ("AUSTRALIA", "anglo"),
    ("NZ", "anglo"), ("NEW ZEALAND", "anglo"), ("IE", "anglo"), ("IRELAND", "anglo"),
    ("DE", "west_eu"), ("GERMANY", "west_eu"), ("FR", "west_eu"), ("FRANCE", "west_eu"), ("NL", "west_eu"), ("NETHERLANDS", "west_eu"), ("BE", "west_eu"), ("BELGIUM", "west_eu"),
    ("AT", "west_eu"), ("AUSTRIA", "west_eu"), ("CH", "west_eu"), ("SWITZERLAND", "west_eu"),
    ("IT", "south_eu"), ("ITALY", "south_eu"), ("ES", "south_eu"), ("SPAIN", "south_eu"), ("PT", "south_eu"), ("PORTUGAL", "south_eu"), ("GR", "south_eu"), ("GREECE", "south_eu"),
    ("SE", "nordics"), ("SWEDEN", "nordics"), ("NO", "nordics"), ("NORWAY", "nordics"), ("DK", "nordics"), ("DENMARK", "nordics"), ("FI", "nordics"), ("FINLAND", "nordics"), ("IS", "nordics"), ("ICELAND", "nordics"),
    ("PL", "east_eu"), ("POLAND", "east_eu"), ("CZ", "east_eu"), ("CZECHIA", "east_eu"), ("HU", "east_eu"), ("HUNGARY", "east_eu"), ("RO", "east_eu"), ("ROMANIA", "east_eu"),
    ("HR", "east_eu"), ("SK", "east_eu"), ("SI", "east_eu"), ("BG", "east_eu"), ("LT", "east_eu"), ("LV", "east_eu"), ("EE", "east_eu"),
    ("BR", "latam"), ("BRAZIL", "latam"), ("MX", "latam"), ("MEXICO", "latam"), ("AR", "latam"), ("ARGENTINA", "latam"), ("CO", "latam"), ("CL", "latam"),
    ("SA", "mena"), ("SAUDI ARABIA", "mena"), ("AE", "mena"), ("UNITED ARAB EMIRATES", "mena"), ("QA", "mena"), ("QATAR", "mena"), ("EG", "mena"),
    ("KR", "east_asia"), ("SOUTH KOREA", "east_asia"), ("JP", "east_asia"), ("JAPAN", "east_asia"), ("HK", "east_asia"), ("HONG KONG", "east_asia"), ("TW", "east_asia"), ("TAIWAN", "east_asia"),
    ("ID", "sea"), ("INDONESIA", "sea"), ("MY", "sea"), ("PH", "sea"), ("TH", "sea"), ("VN", "sea"), ("SG", "sea"), ("SINGAPORE", "sea"),
]
# Language and the region that is taken for it where no country is known.
LANGUAGE_REGIONS = [
    ("en", "anglo"), ("de", "west_eu"), ("fr", "west_eu"), ("nl", "west_eu"), ("it", "south_eu"), ("es", "south_eu"), ("pt", "south_eu"), ("el", "south_eu"),
    ("sv", "nordics"), ("no", "nordics"), ("da", "nordics"), ("fi", "nordics"), ("pl", "east_eu"), ("cs", "east_eu"), ("hu", "east_eu"), ("ro", "east_eu"),
    ("ar", "mena"), ("tr", "mena"), ("fa", "mena"), ("he", "mena"), ("ko", "east_asia"), ("ja", "east_asia"), ("zh", "east_asia"),
    ("id", "sea"), ("ms", "sea"), ("th", "sea"), ("vi", "sea"), ("tl", "sea"), ("fil", "sea"), ("ru", "east_eu"), ("uk", "east_eu"),
]
DEFAULT_REGION = "anglo"
# Region, label, searches, and its trend.
REGION_MUSIC = [
    ("anglo", "US/UK/CA/AU — cozy-aesthetic", ["lofi chill", "cozy acoustic", "aesthetic indie", "soft piano calm", "warm chillhop"], "Cozy 'that-girl' lofi + warm acoustic own US/UK plant & home content; understated, no drops."),
    ("west_eu", "DE/FR/NL — refined minimal", ["minimal acoustic", "melodic chill house", "french touch chill", "calm electronica", "soft piano"], "Refined, minimal beds; subtle melodic house works for FR/DE feature demos."),
    ("south_eu", "IT/ES/PT — warm mediterranean", ["mediterranean acoustic", "warm guitar happy", "indie pop sunny", "bossa acoustic", "feel good acoustic"], "Sun-warm acoustic guitar + light indie-pop; emotive, family-warm tone resonates in IT/ES/PT."),
    ("nordics", "SE/NO/DK/FI — airy dream", ["airy indie folk", "dream pop ambient", "minimal piano", "scandinavian chill", "calm ambient"], "Airy, spacious indie-folk & dream-pop; very calm, design-led aesthetic."),
    ("east_eu", "PL/CZ/RO — folk-tinged chill", ["acoustic pop chill", "folk acoustic warm", "calm electronica", "soft indie", "uplifting acoustic"], "Acoustic-pop & gentle electronica; warm folk tint plays well in PL/CZ/RO."),
    ("latam", "BR/MX — tropical feel-good", ["bossa nova chill", "tropical acoustic happy", "latin acoustic feel good", "uplifting latin", "sunny ukulele"], "Tropical/bossa acoustic + sunny feel-good; energetic-but-warm wins BR/MX home content."),
    ("mena", "AR/SA/AE — calm oud-fusion", ["arabic ambient calm", "oud chill", "middle east ambient", "ethnic chill calm", "spa oriental"], "Calm oud/ethnic-fusion ambient; soft, premium, never aggressive for MENA wellness."),
    ("east_asia", "KR/JP — kawaii city-pop", ["kawaii cute", "city pop chill", "lofi cute", "soft k indie", "gentle piano cute"], "Cute kawaii + city-pop/lofi; gentle, aesthetic, playful for KR/JP."),
    ("sea", "ID/PH/TH/VN — tropical cheerful", ["tropical pop happy", "cheerful acoustic", "lofi tropical", "ukulele happy", "sunny pop"], "Cheerful tropical-pop & ukulele; bright, optimistic tone for SEA."),
]
# Energy, cluster, mood, beats a minute, and the search that goes with it.
ENERGY_MUSIC = [
    ("calm", "C_lofi_chill", "calm / satisfying / ASMR-friendly", "70-90", "lofi chill"),
    ("uplift", "B_uplifting", "uplifting build / hopeful / feel-good", "95-120", "uplifting acoustic"),
    ("tension", "A_calm_nature", "intriguing tension -> warm resolve (hook-friendly)", "85-110", "curious minimal"),
    ("modern", "D_corporate", "clean / modern / positive (app demo)", "100-124", "positive corporate"),
]
# What is said of clips with a voice and without.
VOICED = "VOICE bed: instrumental, low-energy, NO vocal samples, steady (ducked under VO). Use Pixabay's 'instrumental' filter."
UNVOICED = "MUSIC-ONLY hero: trendier/hookier OK, more character & energy."

# Model, requests a minute, tokens a minute, requests a day.
MODEL_LIMITS = {
    "gemini-2.5-flash-lite": (20, 250_000, 20),
    "gemini-2.5-flash": (10, 250_000, 250),
    "gemini-2.5-pro": (5, 250_000, 100),
    "gemini-2.0-flash": (15, 1_000_000, 0),
}
DEFAULT_MODEL = "gemini-2.5-flash-lite"


def languages() -> list[tuple[str, str, str, list[str]]]:
    """(code, native folder, English name, aliases) in order."""
    return [(code, native, english, [code, english.lower(), *more]) for code, native, english, more in LANGUAGES]


def aliases() -> dict[str, str]:
    """Lower-cased alias to native folder; an alias may be given with ``other_`` in front."""
    out = {}
    for _, native, _, names in languages():
        out[native.lower()] = native
        for x in names:
            out[x] = out[f"other_{x}"] = native
    return out
