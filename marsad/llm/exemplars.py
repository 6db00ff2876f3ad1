"""Labelled exemplars of template residue, written as phrases with alternatives: (a|b|) stands for a, b or nothing.

All exemplars of a kind are the expansions of its phrases. Digits stand for any number, 0x for any code
of digits and letters.
"""

from __future__ import annotations

import itertools
import re

# Filler, in English, Arabic and French.
FILLER = """
lorem ipsum dolor sit amet
lorem ipsum
(sample|dummy|placeholder|filler|example|temporary) text (sample|dummy|placeholder|filler|example|temporary) text
(this is|here is|) (a placeholder|placeholder text|dummy text|sample text only|filler text|just filler text|temporary text) (for|to be replaced|to replace|until|only)
this is a placeholder
this is (placeholder|dummy|filler|sample|temporary) (text|copy|content)
test test 0
testing testing 0
asdf asdf qwer asdf
qwerty qwerty qwerty
blah blah blah blah
foo bar foo bar baz
xxx xxx xxx
(your|add your|enter your|put your|write your|type your|insert your|place your) (text|content|description|copy|message|headline|paragraph) (here|goes here|in this area|in this space|in this box)
(insert|add|put|enter|type|place|paste) (text|content|copy|description|paragraph|body text) here
(text|content|copy|description|caption|body text|headline|details) goes here
(text|content|copy|description|caption|summary|details) (to be added|to be written|to be filled in|to be supplied|to come|to follow|will be added|will follow) (soon|later|here|shortly)
(content|description|text|details) coming soon
to be filled in later
temporary (copy|text) to fill the (box|space)
todo (write|add|fill in|complete|finish|replace|insert) (this|the|) (section|text|content|paragraph|description|part|intro)
(replace|change|edit|delete) this (text|placeholder|sentence|paragraph) (with your own|before publishing|before launch|later)
click here to (edit|add) (this|your|) text
double click to edit
نص تجريبي نص تجريبي نص تجريبي
نص مؤقت نص مؤقت
تجربة تجربة 0
اختبار اختبار 0
بلا بلا بلا بلا
(كلام|نص|محتوى) (مؤقت|تجريبي) (لتعبئة المساحة|لملء الفراغ|لملء المساحة|لحجز المكان)
هذا (نص|محتوى|وصف|عنوان) (تجريبي|مؤقت|افتراضي|وهمي)
(سيتم|سوف يتم) (إضافة|ادراج|كتابة) (النص|المحتوى|الوصف|التفاصيل) (هنا|) (قريبا|لاحقا)
(يضاف|سيضاف|يوضع|يكتب) (النص|المحتوى|الوصف|العنوان) (هنا|) (قريبا|لاحقا|هنا)
هنا يوضع المحتوى لاحقا
(أدخل|اكتب|أضف|ضع) (النص|العنوان|الوصف|المحتوى|نصك|وصفك) (هنا|في هذه المساحة|في هذا المكان)
(استبدل|احذف|عدل) هذا النص (قبل النشر|بنصك|لاحقا)
هذا النص هو مثال لنص يمكن أن يستبدل في نفس المساحة
(المحتوى|النص|الوصف) (قيد الإعداد|قيد الكتابة|تحت الإعداد)
texte à ajouter bientôt
le contenu sera ajouté (bientôt|prochainement|plus tard)
(votre|saisissez votre|entrez votre|ajoutez votre|écrivez votre|insérez votre|tapez votre) (texte|contenu|description|message) (ici|dans cette zone|dans cet espace)
(texte|contenu|description) (provisoire|factice|de remplissage) (texte|contenu|) (provisoire|à remplacer|)
ceci est un (texte provisoire|texte factice|faux texte|texte de remplissage)
(texte|contenu|description|résumé) (à venir|à compléter|à rédiger|à remplir) (bientôt|prochainement|plus tard|ici)
(remplacez|modifiez|supprimez) ce texte (avant publication|par le vôtre)
cliquez ici pour modifier (ce|le) texte
à compléter plus tard
"""
# Notices and error messages of sites.
NOTICE = """
error 0
error 0 (page not found|the page you asked for was not found|not found|forbidden)
0 (not found|forbidden|internal server error|bad gateway|service unavailable|gateway timeout|unauthorized|bad request|page not found)
(internal server error|bad gateway|service unavailable|service temporarily unavailable|gateway timeout|access denied|permission denied|access forbidden|bad request)
(the|this|that|requested|the requested|) (page|file|url|resource|address|document|article) (was not found|could not be found|cannot be found|can t be found|does not exist|doesn t exist|no longer exists|has been removed|has been deleted|has been moved|is not available|is unavailable)
the page you (asked for|are looking for|requested|were looking for) (was not found|could not be found|does not exist|doesn t exist|is not here|has been removed|has moved)
we (can t|cannot|could not|couldn t) find (the|that|this) page
the requested url was not found on this server
(this|the) site can t be reached
(site|server|page|host) (is not responding|took too long to respond|not responding|is unreachable|cannot be reached|could not be reached)
could not reach the server
(could not|cannot|unable to|failed to) (connect to|reach|open|load|contact|access) (the|) (database|server|page|content|resource|site|host|service)
(error|problem) (establishing|opening|with) (a|the|) (database connection|connection)
(error|problem) (loading|rendering|fetching|processing) (the|this|your|) (page|content|template|request|resource)
(no results because|) the database connection was lost
(connection|request|session|operation) (timed out|was reset|was refused|was lost|reset|refused|expired)
request timed out after 0 ms reload to try again
you (do not have|don t have|lack) permission to (view|access|see|open) this (page|resource|content|site)
you (are not authorized|are not allowed|have been blocked|are blocked) (to view|to access|from accessing|from viewing) this (page|resource|content|site)
unhandled exception in module view 0x at render page 0
(unhandled|uncaught) exception
(undefined|unknown) (offset|index|variable|property|method)
warning undefined offset 0 in srv app 0x tpl
(fatal error|syntax error|parse error|runtime error|stack trace|null pointer exception|segmentation fault)
traceback most recent call last
failed to load resource 0x
too many requests
(rate limit|request limit|quota) (exceeded|reached)
slow down and try again
(oops|whoops|sorry) (something went wrong|nothing lives at this address any more|that page does not exist|we can t find that page|this page is gone)
something (went wrong|broke|broke on our side|has gone wrong|failed)
(an|an unexpected|an internal|an unknown) error (occurred|has occurred|happened)
(we are|we re) (experiencing|having) (technical difficulties|technical problems|an outage)
(please|) (try|check) again (later|soon|shortly|in a moment|in a few minutes|in a few moments)
(reload|refresh) (the page|this page|your browser|to try again|and try again)
(incident|reference) 0x
fatal could not connect to database at line 0
(your|the|this) (session|login|token) (has expired|expired|has timed out|is no longer valid)
(sign|log) in again
(sign|log) in to (continue|view this page|view this content)
checking (that you are not a robot|your browser before accessing|if the site connection is secure)
(verify|confirm|prove) (that|) you are (a human|human|not a robot)
(complete|solve) the (captcha|security check)
(this|the) (content|video|page|site|service) is (not available|not offered|unavailable|blocked) in your (country|area|region|location)
(the|this|our|) (site|website|page|service|server) is (down|closed|offline|unavailable) for (maintenance|scheduled maintenance|an upgrade)
(we are|we re) down for maintenance back soon
(site|website|page|service) (under|undergoing|in) (maintenance|scheduled maintenance)
the link you followed (is no longer available|is broken|has expired|may be broken)
(javascript|scripts|scripting|cookies|scripts and cookies|javascript and cookies) (must be|should be|need to be|needs to be|has to be|have to be|is|are) (enabled|turned on|switched on|allowed|activated|required|needed|disabled|blocked|turned off|switched off)
(you need to|you must|you have to|please|) (enable|turn on|switch on|allow|activate|accept) (javascript|scripts|scripting|cookies|scripts and cookies|javascript and cookies) (to|in order to|before|for|and|in)
(to|in order to) (use|view|see|display|open|access|load|run|visit) (this|the|our) (site|website|page|content|app|application)
(this|our|the) (site|website|page|app|application|content|service) (requires|needs|relies on|depends on|uses) (javascript|scripts|scripting|cookies|a newer browser|a modern browser|a browser with scripting)
(this|our|the) (site|website|page|app) (does not work|will not work|doesn t work|won t work|cannot run|can t run) without (javascript|scripts|cookies)
a browser with scripting turned on
your browser (does not support|doesn t support|has disabled|blocks|is blocking) (javascript|scripts|cookies|this site|this feature)
(your|this) browser is (out of date|outdated|too old|not supported|no longer supported|unsupported)
(please|) (update|upgrade) your browser
(please|) (use|switch to|try) (another|a different|a newer|a modern|a supported) browser
javascript is disabled turn it on and reload
turn it on and reload
if nothing (shows|appears|loads) allow scripts for this site
we could not start the page because client code is blocked
loading please wait
خطأ 0
خطأ 0 الصفحة المطلوبة غير موجودة
(الصفحة|الصفحة المطلوبة|الصفحة التي تبحث عنها|الملف المطلوب|العنوان المطلوب|الرابط المطلوب) (غير موجودة|غير موجود|لم يعد موجودا|لم تعد موجودة|غير متاحة|غير متاح|لا وجود لها|لا يمكن العثور عليها)
(لم نجد|لم يتم العثور على|لا يمكن العثور على|تعذر العثور على) (الصفحة|هذه الصفحة|الصفحة المطلوبة|الملف المطلوب)
(عذرا|عفوا|) تعذر (الوصول إلى|الاتصال مع|فتح|تحميل|عرض) (الخادم|الصفحة|المحتوى|الموقع|قاعدة البيانات)
(تعذر|فشل) (الاتصال بالخادم|الاتصال بقاعدة البيانات|تحميل المحتوى|تحميل الصفحة|التحميل)
فشل التحميل 0x
فشل تحميل المحتوى 0x
رقم المرجع 0x
تعذر إكمال العملية مهلة الاتصال انتهت بعد 0 مللي ثانية
(انتهت مهلة|انقطع) (الاتصال|الطلب|الاتصال بالخادم)
الرابط الذي فتحته لم يعد متاحا ارجع للصفحة الأولى
لا توجد نتائج لأن الاتصال بقاعدة البيانات انقطع
(حدث|وقع|حصل) (خلل|خطأ|خطأ غير متوقع|خلل داخلي|خطأ داخلي|خطأ ما) (داخلي|في الخادم|حاول لاحقا|أثناء التحميل|حاول مرة أخرى)
حدث (خلل|خطأ)
(يرجى|الرجاء|) (المحاولة|حاول|أعد المحاولة) (لاحقا|مرة أخرى|بعد قليل|بعد دقائق)
(أعد|يرجى إعادة) (تحميل|تحديث) (الصفحة|الموقع)
(غير مصرح لك|ليس لديك صلاحية|لا تملك صلاحية|ليس مسموحا لك) (بعرض|لعرض|للوصول إلى|بالوصول إلى) (هذا المحتوى|هذه الصفحة)
غير مصرح لك بعرض هذا المحتوى رمز 0
(تم رفض|رفض) (الوصول|الدخول)
(الموقع|الخدمة|الصفحة) (تحت الصيانة|قيد الصيانة|مغلق للصيانة|متوقفة للصيانة) (حاليا|مؤقتا|)
تم تجاوز (عدد|الحد الأقصى لعدد) الطلبات (المسموح|المسموح بها) (انتظر قليلا|)
انتهت (صلاحية|مدة) (الجلسة|جلستك) (سجل الدخول من جديد|سجل الدخول مرة أخرى|)
سجل الدخول (من جديد|مرة أخرى|للمتابعة)
(هذا|هذه) (المحتوى|الخدمة|الفيديو) (غير متاح|غير متاحة|غير متوفر) في (منطقتك|بلدك|دولتك)
(نتحقق|تحقق|نتأكد) من أنك (لست روبوت|لست برنامج|إنسان) (لحظة|)
الصفحة تحتاج متصفحا أحدث مع javascript مفعل
لعرض هذا المحتوى اسمح بتشغيل الشيفرة في المتصفح
متصفحك لا يدعم (النصوص البرمجية|جافا سكربت|javascript|هذه الميزة)
فعلها ثم أعد التحميل
متصفحك (قديم|غير مدعوم|لم يعد مدعوما)
(يرجى|الرجاء|يجب|عليك|) (تفعيل|تشغيل|السماح) (جافا سكربت|جافاسكربت|javascript|السكربتات|ملفات الارتباط|ملفات تعريف الارتباط|الكوكيز) (في متصفحك|لعرض الصفحة|للمتابعة|لاستخدام الموقع|لتصفح الموقع)
(هذا|هذه) (الموقع|الصفحة|التطبيق) (لا يعمل|لا تعمل|لن يعمل) (بدون|من دون|دون) (تشغيل|تفعيل) (السكربتات|جافا سكربت|ملفات الارتباط|javascript)
(الموقع|الصفحة|هذا الموقع|هذه الصفحة) (يتطلب|تتطلب|يحتاج|تحتاج) (تفعيل|تشغيل|متصفحا) (جافا سكربت|جافاسكربت|javascript|حديثا|أحدث)
(السكربتات|وملفات الارتباط|ملفات الارتباط|جافا سكربت|javascript) (غير مفعلة|غير مفعل|معطلة|معطل)
javascript غير مفعل شغله ثم حدث الصفحة
جاري التحميل إذا لم يظهر شيء اسمح بالسكربتات
(يرجى|الرجاء|) (تحديث|ترقية) (متصفحك|المتصفح)
(يرجى|الرجاء|) (استخدام|استخدم|جرب) متصفح (آخر|حديث|أحدث)
erreur 0
erreur 0 page (introuvable|non trouvée)
(cette|la) page (n existe pas|n existe plus|demandée est introuvable|est introuvable|a été supprimée|a été déplacée|est indisponible)
(n existe pas|n existe plus) ou a été (supprimée|déplacée)
page (introuvable|non trouvée)
(accès|accès à cette page) (refusé|interdit)
(une erreur|une erreur inattendue|une erreur interne) (est survenue|s est produite)
(veuillez|merci de|) (réessayer|réessayez) (plus tard|ultérieurement|dans quelques minutes)
(impossible de|échec de) (se connecter|charger|joindre|contacter|connexion) (au serveur|à la base de données|le serveur|la page|le contenu)
(erreur de|perte de) connexion (à la base de données|au serveur)
(le serveur|le site|la page) ne répond pas
(vous n avez pas|vous n êtes pas) (l autorisation|la permission|autorisé) (de|à) (consulter|voir|accéder à) cette page
(veuillez|merci d|vous devez|) (activer|activez|autoriser|accepter) (javascript|les cookies|les scripts) (pour afficher|pour utiliser|pour continuer|pour accéder|dans votre navigateur|afin de)
javascript (doit être|est) (activé|désactivé|requis|nécessaire|bloqué)
votre navigateur (ne prend pas en charge|ne supporte pas|bloque) (javascript|les cookies|cette fonction)
votre navigateur (est obsolète|n est plus pris en charge|est trop ancien)
(ce|notre|le) site (nécessite|requiert|a besoin de|utilise|exige) (javascript|les cookies|un navigateur récent)
(ce|le) (site|service) est (en maintenance|indisponible|fermé pour maintenance) (actuellement|momentanément|)
votre session (a expiré|est expirée) (reconnectez vous|veuillez vous reconnecter|)
(vérifiez|confirmez|prouvez) que vous n êtes pas un robot
(ce|cette) (contenu|vidéo|page) n est pas disponible dans votre (pays|région)
trop de requêtes
le lien que vous avez suivi (est rompu|n est plus valable|a expiré)
(mettez|veuillez mettre) à jour votre navigateur
"""
# Navigation around a notice.
MENU = """
(home|contact|contact us|about|about us|search|site map|sitemap|log in|sign in|menu|back|go back|go home|return home|reload|help|home page|privacy|terms)
(الرئيسية|اتصل بنا|من نحن|البحث|خريطة الموقع|تسجيل الدخول|العودة للرئيسية|مساعدة|القائمة)
(accueil|recherche|plan du site|à propos|contact|retour|retour à l accueil|connexion|aide)
"""
# Real text that speaks about notices, filler or placeholders; a match keeps the value.
TALK = """
how (do i|can i|do you|can you|to|would i) (enable|fix|solve|allow|handle|turn on|disable|debug|remove|avoid)
what (does|is) (error|a 0|the error|this error|the message|placeholder text)
(and|but|so|what) if (a|an|the|it|this|my|your|i|we)
why (do i|does my|is my|does the|is the|do we) (get|see|page|site|browser|server)
(error|code|message|status|notice) (means|tells you|appears when|shows up when|usually means|says that|was caused by)
(is|are|was|were) caused by
(means|meaning|mean) (that|the server|the page)
(the|our|my) (team|developer|developers|engineer|designer|editor|user|users|client) (fixed|wrote|saw|got|found|removed|replaced|uses|calls|forgot)
(كيف|وش|ليش|لماذا|متى|هل) (أفعل|أشغل|أحل|أصلح|أعالج|تظهر|يظهر|يعني|معنى|أتخلص من)
(يعني|تعني|معناه|معناها|يدل|تدل) (أن|على|هذا)
(comment|pourquoi) (activer|corriger|résoudre|désactiver|régler|mon|ma|le|la)
(signifie|veut dire|indique) que
"""
# Words of the usual filler in Latin; a passage made of them is filler. Cut forms are included.
LATIN_FILLER = """
lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua
enim minim veniam quis nostrud exercitation ullamco laboris nisi aliquip commodo consequat duis aute irure reprehenderit
voluptate velit esse cillum eu fugiat nulla pariatur excepteur sint occaecat cupidatat non proident sunt culpa qui officia
deserunt mollit anim id est laborum consec lectus viverra ultric ultrices ultricies mauris nisl feugiat porta sodal sodales
fusce orci tellus vitae aenean dapib dapibus vestibulum pellentesque curabitur praesent suspendisse ligula
"""
# What stands in unfilled placeholders.
SLOT = """
(insert|enter|add|type|put|write|your|the|a|of|here|to|please|fill|in|todo|tbd|tba|xx|xxx|placeholder) (name|names|first|last|full|title|date|dates|day|time|city|country|town|state|street|address|email|mail|phone|number|company|organization|organisation|department|position|role|job|product|products|order|customer|client|user|users|username|account|amount|price|total|currency|quantity|id|code|text|content|description|link|url|website|image|photo|logo|event|location|venue|topic|subject|school|university|course|team|manager|employer|recipient|sender|signature|invoice|reference|year|month|company's|reason|item|service|project|value|details|info|information|heading|summary|author|article|section|category|password|guest|host|patient|doctor|teacher|student)
(أدخل|ادخل|اكتب|أضف|ضع|هنا|من|في) (اسم|الاسم|العميل|عنوان|العنوان|المقال|التاريخ|تاريخ|المدينة|مدينة|الرقم|رقم|الشركة|شركة|البريد|الإلكتروني|الهاتف|الجوال|المبلغ|السعر|المنتج|الطلب|اليوم|الوقت|الموضوع|النص|الوصف|الرابط|المستخدم|المدير|المرسل|المستلم|القسم|الوظيفة|المدرسة|الجامعة|الدولة|الشارع|التوقيع|الفاتورة|المكان|الموقع|الحساب|المؤسسة|الجهة|الشهر|السنة|الضيف|الكامل|الأول|الأخير)
(votre|vos|le|la|l|de|du|des|insérer|insérez|entrez|saisir|saisissez|indiquer|indiquez|ici|à|compléter) (nom|prénom|date|ville|pays|adresse|rue|numéro|téléphone|courriel|société|entreprise|poste|produit|commande|client|montant|prix|titre|texte|sujet|lieu|heure|signature|référence|lien|objet|destinataire|expéditeur|école|université|année|mois|jour|service|compte)
"""

_CHOICE = re.compile(r"\(([^()]*)\)")


def expand(block: str) -> list[str]:
    """All phrases of a block, in order, each once."""
    out: dict[str, None] = {}
    for line in block.strip().splitlines():
        parts = [[p] if i % 2 == 0 else p.split("|") for i, p in enumerate(_CHOICE.split(line))]
        for choice in itertools.product(*parts):
            out[" ".join("".join(choice).split())] = None
    return list(out)
