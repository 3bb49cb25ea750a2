"""Fixed values of Hebrew texts: forms whose spelling hides the addressee's gender, words of command, pauses."""

# Rule, spelling, form with vowels to a woman, to a man.
AMBIGUOUS = [
    ("POSS_SHEL", "שלך", "שֶׁלָּךְ", "שֶׁלְּךָ"),
    ("PRON_OTKH", "אותך", "אוֹתָךְ", "אוֹתְךָ"),
    ("PRON_ITKH", "אתך", "אִתָּךְ", "אִתְּךָ"),
    ("PREP_LAKH", "לך", "לָךְ", "לְךָ"),
    ("PREP_BAKH", "בך", "בָּךְ", "בְּךָ"),
    ("PREP_MIMEKH", "ממך", "מִמֵּךְ", "מִמְּךָ"),
    ("PREP_ALAIKH", "עליך", "עָלַיִךְ", "עָלֶיךָ"),
    ("PREP_ELAIKH", "אליך", "אֵלַיִךְ", "אֵלֶיךָ"),
    ("VERB_HALAKHT", "הלכת", "הָלַכְתְּ", "הָלַכְתָּ"),
    ("VERB_ASIT", "עשית", "עָשִׂיתְ", "עָשִׂיתָ"),
    ("VERB_KHASHAVT", "חשבת", "חָשַׁבְתְּ", "חָשַׁבְתָּ"),
    ("VERB_DIBART", "דיברת", "דִּיבַּרְתְּ", "דִּיבַּרְתָּ"),
    ("VERB_YADAT", "ידעת", "יָדַעְתְּ", "יָדַעְתָּ"),
    ("VERB_HAYIT", "היית", "הָיִיתְ", "הָיִיתָ"),
    ("VERB_RATSIT", "רצית", "רָצִיתְ", "רָצִיתָ"),
    ("VERB_ANIT", "ענית", "עָנִיתְ", "עָנִיתָ"),
    ("VERB_AMART", "אמרת", "אָמַרְתְּ", "אָמַרְתָּ"),
    ("VERB_SHAMAT", "שמעת", "שָׁמַעְתְּ", "שָׁמַעְתָּ"),
    ("VERB_RAIT", "ראית", "רָאִיתְ", "רָאִיתָ"),
    ("VERB_LAKAKHT", "לקחת", "לָקַחְתְּ", "לָקַחְתָּ"),
    ("VERB_NATATT", "נתת", "נָתַתְּ", "נָתַתָּ"),
    ("VERB_BAT", "באת", "בָאתְ", "בָאתָ"),
    ("VERB_YATSAT", "יצאת", "יָצָאתְ", "יָצָאתָ"),
    ("VERB_SHAKHAKHT", "שכחת", "שָׁכַחְתְּ", "שָׁכַחְתָּ"),
    ("VERB_HITKHALAT", "התחלת", "הִתְחַלְתְּ", "הִתְחַלְתָּ"),
    ("VERB_HIFSAKT", "הפסקת", "הִפְסַקְתְּ", "הִפְסַקְתָּ"),
]
# Words of command that end a sentence.
COMMANDS = "עכשיו ברור לך צא שב עמוד תשתוק תפסיק בצע תעשה תקשיב תסתכל תראה בוא תגיד תחתום".split()
# Filled pauses.
PAUSES = "אממ אה אנ".split()
