"""Pattern tables of the title filters, as plain text: one pattern a line.

Patterns are case-insensitive and Unicode-aware; ``matcher`` joins a table into one alternation.
"""

from __future__ import annotations

# Titles that the full filter refuses.
REJECT = r"""
短剧
总裁
重生
甜宠
完結
大结局
#cdrama
#chinesedrama
#koreandrama
#kdrama
#泰剧
mafia boss
CEO spoil
billionaire spoil
addicted to her
obsessed with her
dotes on her
pampered by
spoiled nightly
spoils? (me|her|him) boundless
reborn.{0,20}(princess|CEO|boss|marry|husband|wife)
humiliat.{0,30}(marry|wed|boss)
forced to (marry|wed)
betray.{0,20}(marry|wed|husband)
revenge.{0,20}(marry|wed|CEO|boss)
full movie\]
full movie[)\s]
\[Full Movie\b
Revenge Thriller
love story.{0,20}(CEO|boss|billionaire)
\bmusic video\b
\bofficial (music )?video\b
\blyric(s)? video\b
\bofficial audio\b
\bofficial MV\b
\bcover song\b
\bkaraoke\b
\bremix\b
\bplaylist\s*[|·•-]\s*(chill|study|lofi|relax)
\blofi\b.*\b(beats|hip hop|study|chill)\b
\bchill\b.*\b(beats|vibes|mix)\b
\b(lo-fi|lo fi)\b.*\b(beats|music)\b
\bstudy music\b
\brelaxing music\b
\bsleep music\b
\brain sounds?\b
\bwhite noise\b
\bnature sounds?\b.*\b(sleep|relax)
\bambient\b.*\b(music|sounds?)\b
\bconcert\b.*\b(live|full)\b
\bmusic for (study|sleep|relax|focus)
\bASMR\b
\basmr\b
\btingles\b
\bwhisper(ing|ed)?\b.*\b(roleplay|triggers)
\bsoft.spoken\b
\blet'?s?\s*play\b
\bgameplay\b
\bwalkthrough\b
\bplaythrough\b
\bspeedrun\b
\bfortnite\b
\bminecraft\b(?!.*\b(redstone|computer|tutorial|education))
\broblox\b
\bgta\s*[v5]?\b
\bcall of duty\b
\bfifa\b\s*\d
\bleague of legends\b
\bvalorfortnite\b
\bgaming\b(?!.*\b(theory|industry|design|history|AI))
\bstream highlight
\btwitch\b.*\b(stream|clip|highlight)
\bgamer\b(?!.*\b(gate|theory))
\besports?\b
\bvlog\b
\b(morning|night|skincare|gym) routine\b
\bget ready with me\b
\bgrwm\b
\bday in (my|the) life\b
\bwhat i eat\b
\b(room|house|apartment|closet|fridge) tour\b
\bgrocery haul\b
\bclothing haul\b
\btry.on haul\b
\bhaul\b.*\b(shein|zara|primark|h&m)
\bunboxing\b(?!.*\b(lab|equipment|kit))
\bfamily vlog\b
\btravel vlog\b
\bcouples?\b.*\b(challenge|prank|react)
\bprank\b(?!.*\b(call|theory|psychology))
\b(24|48|72) hour challenge\b
\btry not to (laugh|cry|cringe)\b
\breaction\b(?!.*\b(mechanism|chemical|nuclear|rate|kinetics))
\breact(s|ing)?\b.*\b(to|video|trailer)
\bchallenge video\b
\bfood challenge\b
\bsocial experiment\b(?!.*\b(research|psychology|study))
\bDhar Mann\b
\bcelebrity\b.*\b(gossip|scandal|drama)
\b(tea|☕)\b.*\b(spill|drama)
\bexposed\b(?!.*\b(API|vulnerability|radiation|surface))
\bcancelled?\b(?!.*\b(class|course|flight|event))
\bdrama\b.*\b(update|alert|channel)
\bstorytime\b(?!.*\b(read|children|book))
\bsermon\b.*\b(sunday|church|pastor)
\bworship\b.*\b(live|service|night)
\bprayer\b.*\b(meeting|live|service)
\bbibl(e|ical)\b.*\b(devotion|worship|prayer)
\b(match|game) highlight
\bfull (match|game|fight)\b(?!.*\b(theory|analysis|lecture))
\b(NBA|NFL|FIFA|UFC|WWE|boxing|MMA)\b(?!.*\b(analytics|statistics|physics|economics))
\bgoals?\s*&?\s*highlights?\b
\brecipe\b(?!.*\b(algorithm|success|formula|molecular))
\bmukbang\b
\beating\b.*\b(challenge|show|sounds?)\b
\bwhat i (ate|cooked)\b
\bflat earth\b(?!.*\b(debunk|refut|myth))
\bchemtrail\b
\billuminati\b(?!.*\b(history|documentary|debunk))
\bQ\s*Anon\b
\bnursery rhyme\b
\bkids (song|cartoon|animation)\b
\bcocomelon\b
\bbaby shark\b
\bpeppa pig\b
#shorts\b
\bsatisfying\b.*\b(video|compilation)
\boddly satisfying\b
\bcompilation\b(?!.*\b(lecture|course|compiler))
\bfunny moments?\b
\bepic fail\b
\btop\s*\d+\s*(most|best|worst|scariest|craziest)
\b(you won\'?t believe|what happens next|gone wrong)\b
""".strip().split("\n")

# Strong marks of a course.
TIER_9 = r"""
\b(CS|EE|ECE|EECS|MATH|PHYS|CHEM|BIO|STAT|ECON)\s*\d{2,4}\b
\bMIT\s+\d+\.\d+
\b(6|18|8|7|14|15)\.\d{2,3}\b
\bCS\d{3}\b
\bLecture\s+\d+\s*[\|:\-–]
\bLec\s+\d+\b
\bWeek\s+\d+\s*[\|:\-–]
\bModule\s+\d+\b.*\b(lecture|class)
\bMIT\s*OpenCourseWare\b
\bOCW\b
\bNPTEL\b
\bCoursera\b
\bedX\b
\bKhan Academy\b
\bStanford\s+(CS|EE|MATH|Online)
\bHarvard\s+(CS|STAT|Extension)
\bYale\s+(Open|Courses)
\bBerkeley\s+(CS|EE|MATH|STAT)
\bCaltech\b.*\b(lecture|course)
\bCarnegie\s+Mellon\b
\bGeorgia\s+Tech\b.*\b(lecture|course)
\bfull course\b
\bcomplete course\b
\bcourse playlist\b
\blecture series\b
\blecture notes?\b
\bsyllabus\b
\bfinal exam\b.*\b(review|prep)
\bmidterm\b.*\b(review|prep)
\brecitation\b
\bproblem set\b
\boffice hours?\b.*\b(lecture|professor|prof)
\b(ICML|NeurIPS|NIPS|CVPR|ICLR|ACL|EMNLP|AAAI|IJCAI|KDD|SIGMOD|VLDB|SOSP|OSDI)\b
\b(NSDI|SIGCOMM|CCS|Oakland|USENIX|PLDI|POPL|ICFP|OOPSLA|ISCA|MICRO|ASPLOS)\b
\b(CHI|SIGGRAPH|RSS|ICRA|IROS|CoRL|ICCV|ECCV|WACV|INTERSPEECH|ICASSP)\b
\boral\s+presentation\b
\bspotlight\s+(talk|presentation)\b
\binvited\s+talk\b
\bkeynote\b.*\b(address|speech|lecture)
\bлекция\b
\bкурс\b
\bуниверситет\b
\bМФТИ\b
\bМГУ\b
\bВШЭ\b
\bVorlesung\b
\bKurs\b.*\bUniversität\b
\bcours\s+magistral\b
\bSorbonne\b
\bcorso\b.*\buniversità\b
\bwykład\b
\bföreläsning\b
\b강의\b
\b講義\b
\b授業\b
\b课程\b
\b公开课\b
""".strip().split("\n")

# Good marks of teaching.
TIER_8 = r"""
\blecture\b
\bcourse\b(?!.*\bgolf\b)
\btutorial\b
\bseminar\b
\bworkshop\b(?!.*\b(wood|craft|DIY)\b)
\bclass\b(?!.*\b(first|business|world)\b)
\bbootcamp\b
\bmasterclass\b
\bsyllabus\b
\buniversity\b
\buniversité\b
\bUniversität\b
\buniversità\b
\buniversidad\b
\buniversidade\b
\bprofessor\b
\bprof\.\s+\w+
\bDr\.\s+\w+.*\b(lecture|talk|course)
\bintroduction to\b
\bintro to\b
\bfundamentals of\b
\bprinciples of\b
\badvanced\b.*\b(topics?|course|lecture)
\bgraduate\b.*\b(course|lecture|level|seminar)
\bundergraduate\b
\bpostgraduate\b
\bPhD\b.*\b(course|lecture|defense|thesis)
\bdoctoral\b.*\b(defense|thesis|dissertation)
\bchapter\s+\d+\b
\bpart\s+\d+\b.*\b(lecture|course|tutorial|series)
\blesson\s+\d+\b
\bunit\s+\d+\b
\bsession\s+\d+\b
\b3Blue1Brown\b
\bNumberphile\b
\bComputerphile\b
\bStatQuest\b
\bThe Organic Chemistry Tutor\b
\bProfessor Leonard\b
\bMichel van Biezen\b
\bPatrick JMT\b
\bDr\.\s*Trefor\b
\bKurzgesagt\b
\bCrash Course\b
\bSciShow\b
\bPBS\s*(Space\s*Time|Eons|Infinite\s*Series)
\bVeritasium\b
\bMinute\s*(Physics|Earth)\b
\bSmarterEveryDay\b
\bBen Eater\b
\bAndrej Karpathy\b
\bYannic Kilcher\b
\bSabine Hossenfelder\b
\btechnical talk\b
\bresearch talk\b
\bcolloqu(ium|ia)\b
\bsympos(ium|ia)\b
\bacademic\b.*\b(talk|presentation|conference)
\bpanel\b.*\b(discussion|debate)
\bdistinguished\b.*\b(lecture|speaker)
\bpublic\b.*\blecture\b
\bTED\b(?!dy)
\bTEDx\b
\bGoogle\s+Tech\s+Talk\b
\balgorithm\b
\bdata\s+structure\b
\bmachine\s+learning\b
\bdeep\s+learning\b
\bneural\s+network\b
\breinforcement\s+learning\b
\bcomputer\s+vision\b
\bnatural\s+language\s+processing\b
\bquantum\s+(mechanics|computing|physics|field)\b
\bthermodynamics\b
\belectromagnet
\borganic\s+chemistry\b
\bbiochemistry\b
\bmolecular\s+biology\b
\blinear\s+algebra\b
\bcalculus\b
\bdifferential\s+equations?\b
\breal\s+analysis\b
\babstract\s+algebra\b
\btopology\b
\bnumber\s+theory\b
\bstatistical\s+(mechanics|learning|inference)\b
\bBayesian\b
\bMarkov\b
\bFourier\b
\bLaplace\b
\bHilbert\b
\bRiemann\b
\bEuler\b(?!.*\b(goal|fifa))
""".strip().split("\n")

# Moderate marks of teaching.
TIER_7 = r"""
\bexplained\b
\bin depth\b
\bdeep dive\b
\bhow\s+.*\bwork
\bwhy\s+.*\bmatters?\b
\bhistory of\b
\bscience of\b
\bphysics of\b
\bmath(ematics)? of\b
\btheory of\b
\banalysis of\b
\bdocumentary\b
\bpodcast\b.*\b(interview|discussion|episode)
\bwebinar\b
\bpresentation\b
\bdemonstration\b
\bbreakdown\b(?!.*\b(mental|nervous|emotional))
""".strip().split("\n")

# The short word lists of the admission profiles, each taken between word boundaries.
SHORT_REJECT = (
    "music video|official video|lyric|trailer|reaction|unboxing|prank|asmr|mukbang|tiktok|shorts|#shorts|haul|vlog|grwm|"
    "day in my life|fortnite|minecraft gameplay|roblox|gaming|walkthrough|playthrough|full movie|full episode|"
    "movie clip|behind the scenes|bloopers|live stream|livestream|24 hour challenge|compilation|funny moments|"
    "try not to laugh|satisfying|oddly satisfying"
).split("|")
# Profiles differ in how they spell the apostrophe, and in what they refuse of one game.
PLAY, ANY_PLAY, GTA_V = ["let's play"], ["let.s play"], ["gta v"]
RELIGIOUS = "sermon|prayer|worship|bible study|quran|gospel|church service".split("|")
CONSPIRACY = "conspiracy|flat earth|anti.vax|miracle cure".split("|")
WIDE_REJECT = "get ready with me|scene|challenge video|best of|gta".split("|")
BOOST = (
    r"lecture|course|tutorial|class|seminar|workshop|bootcamp|masterclass|university|professor|MIT|Stanford|Harvard|Yale|"
    r"Berkeley|Oxford|Cambridge|OpenCourseWare|NPTEL|khan academy|introduction to|fundamentals|chapter \d|lesson \d|week \d|"
    r"part \d|module \d"
).split("|")
FOREIGN_BOOST = "лекция|курс|Vorlesung|lezione|wykład|강의|講義|课程".split("|")
FRENCH_BOOST = ["cours"]
BRAND_BOOST = "coursera|edx".split("|")
GRADUATE_BOOST = "advanced|graduate|undergraduate|университет|cours magistral".split("|")
REJECT_CHANNEL = (
    "VEVO|Music|Records|Gaming|Gameplay|Clips|Highlights|TV Show|Movie|Trailer|Entertainment|Comedy|Prank|ASMR|Mukbang|"
    "Cooking Show|Reality|Drama|News Network|ESPN|Sports|NBA|NFL|FIFA"
).split("|")

# Wording that marks a free licence in a description.
FREE_LICENCE = r"""
creative\s*commons
\bcc[\s\-]by\b
licensed?\s+under\s+.*creative
opencourseware
open\s*course\s*ware
ocw\.mit\.edu
open\.edu/openlearn
this\s+work\s+is\s+licensed\s+under
public\s+domain
""".strip().split("\n")


# The published categories, in the order they are tried. The patterns, of the source and of
# the title, are our own; 'unknown' and null follow from there being none.
CATEGORIES = [
    ("university_ocw", r"open ?course ?ware|\bocw\b|open university|nptel", r"open ?course ?ware|\bocw\b|nptel"),
    ("mooc_platform", r"coursera|\bedx\b|khan academy|udacity", r"coursera|\bedx\b|khan academy"),
    ("university_lecture", r"universi|universidad|institut|college|\bdept|академия|университет|институт", r"\b(lecture|vorlesung|clase|cours|aula|лекция)\b"),
    ("conference", r"conference|symposium|\btalks\b", r"\b(keynote|conference|symposium|colloquium)\b"),
    ("corporate_talks", r"\b(inc|gmbh|corp|ltd)\b", r"\b(product launch|earnings call|webinar)\b"),
    ("tech_community", r"\b(devs?|hackers?|meetup|coders?)\b", r"\b(meetup|hackathon|compiler|hash table|code ?generator)\b"),
    ("medical_health", r"hospital|clinic|medical|health", r"\b(surgery|diagnosis|patients?|enzyme)\b"),
    ("government_public", r"ministry|parliament|agency|\bgov\b", r"\b(hearing|parliament|statut\w+|jurisdiction\w*)\b"),
    ("public_media", r"\b(public (radio|television)|broadcasting)\b", r"\bdocumentary\b"),
    ("news_media", r"\b(news|times|herald|tv)\b", r"\b(breaking news|headlines)\b"),
    ("religious", r"church|mosque|temple|ministries", r"\b(sermon|worship|gospel|quran)\b"),
    ("gaming_entertainment", r"gaming|gameplay|entertainment", r"\b(gameplay|let.s play|speedrun|minecraft|fortnite|music video)\b"),
    ("coaching_test_prep", r"coaching|academy|tutor", r"\b(exam|test prep|step by step|how to)\b"),
    ("non_english_edu", "", r"\b(introducción|einführung|введение|introdução|tutoriel)\b"),
    ("individual_creator", r"\b(lectures|with|by|channel)\b", r"\b(explained|my|tutorial)\b"),
]


def matcher(patterns: list[str]) -> str:
    """One Java pattern for a table, compiled once a task. Patterns that begin at a word boundary
    share one test of it, so at most places of a title one test fails for all of them."""
    edge = r"\b"
    at_edge = [f"(?:{p.removeprefix(edge)})" for p in patterns if p.startswith(edge)]
    anywhere = [f"(?:{p})" for p in patterns if not p.startswith(edge)]
    if at_edge:
        anywhere.append(edge + "(?:" + "|".join(at_edge) + ")")
    return "(?iU)" + "|".join(anywhere)


def words(*lists: list[str]) -> str:
    """One Java pattern for lists of words between word boundaries."""
    return r"(?iU)\b(" + "|".join(w for one in lists for w in one) + r")\b"
