"""Residue and real text in English, Arabic and French, written apart from the exemplars and used for measuring only."""

RESIDUE = """
JavaScript must be enabled in order to use this website.
Error establishing a database connection
This site can't be reached
Whoops, that page does not exist
Write your description in this area
TODO: write this section
Cette page n'existe pas ou a été supprimée
Please enable JavaScript to continue using this application.
We're sorry, this page could not be found.
The page you were looking for doesn't exist.
404 - Page not found. Go back home.
HTTP Error 503. The service is unavailable.
Your browser is not supported. Please upgrade your browser.
Cookies must be enabled to log in.
You need to turn on cookies to view this site.
Sorry, something went wrong. Please try again later.
An unexpected error has occurred. Please reload the page.
Access denied. You do not have permission to access this resource.
Your session has timed out. Please log in again.
This content is not available in your region.
We are experiencing technical difficulties. Please check back soon.
The website is down for scheduled maintenance.
Too many requests. Please slow down.
Please verify you are a human
Confirm that you are not a robot to continue
Unable to load the page. Check your connection and try again.
Home | About | Contact | Sorry, we can't find that page | Privacy
Connection timed out
Fatal error: uncaught exception
Traceback (most recent call last)
The requested resource is not available
The link you followed may be broken, or the page may have been removed.
This website requires cookies to be enabled
Your browser doesn't support this feature. Try another browser.
Scripts are blocked. Allow scripts and reload the page.
Gateway timeout
500 Internal Server Error
You are not authorized to view this page.
Failed to connect to the server
The server is not responding. Please refresh the page.
Insert content here
Add your text here
Enter your message here and press save
Content coming soon
Description to be added later
The harvest starts in May. Text goes here. Then it rains.
This is placeholder text to be replaced before launch
Replace this text with your own
Click here to edit this text
Lorem ipsum dolor sit amet, consectetur adipiscing
Sed do eiusmod tempor incididunt
blah blah blah blah blah
Hello {{first_name}}, your parcel left today.
Dear [Customer Name], thank you for the order.
Best regards, [Your Name]
Meet us at {{ venue }} on {{ date }}.
The invoice <invoice number> is due on <due date>.
Your code is ${code} and expires tonight.
Hi %(user)s, welcome back.
Welcome to [insert company name here], we are glad you came.
Signed, __YOUR NAME__
Delivery to @@ADDRESS@@ by noon
Please contact [phone number] for help.
Event: [TBD]
Thank you for visiting [Company Name] in [City].
الصفحة التي تبحث عنها غير موجودة
عذراً، لم نجد الصفحة المطلوبة
حدث خطأ غير متوقع، يرجى المحاولة لاحقاً
يرجى تفعيل جافا سكربت في متصفحك للمتابعة
هذا الموقع يتطلب تفعيل جافا سكربت
يجب تفعيل ملفات الارتباط لاستخدام الموقع
متصفحك قديم، يرجى تحديث متصفحك
انتهت صلاحية جلستك، سجل الدخول مرة أخرى
الموقع قيد الصيانة حالياً، حاول لاحقاً
ليس لديك صلاحية للوصول إلى هذه الصفحة
تعذر الاتصال بالخادم
تم رفض الوصول
هذا المحتوى غير متوفر في بلدك
فشل تحميل الصفحة، أعد تحميل الصفحة
خطأ 500 في الخادم الداخلي
تعذر تحميل المحتوى. حاول مرة أخرى بعد قليل
لا يمكن العثور على الصفحة
الرئيسية | من نحن | الصفحة غير موجودة
هذا نص تجريبي
اكتب الوصف هنا
أضف المحتوى هنا
سوف يتم إضافة التفاصيل قريباً
محتوى مؤقت لملء المساحة
المحتوى قيد الإعداد
استبدل هذا النص قبل النشر
عزيزي [اسم العميل]، وصل طلبك
مرحباً {{الاسم}}، شكراً لك
التوقيع: [اسم المدير]
الموعد يوم {التاريخ} في {المكان}
يرسل إلى <العنوان> غداً
Page introuvable
Erreur 404 : la page demandée est introuvable
Une erreur inattendue s'est produite. Veuillez réessayer plus tard.
Veuillez activer les cookies pour continuer
JavaScript est désactivé dans votre navigateur
Votre navigateur n'est plus pris en charge
Ce site nécessite JavaScript pour fonctionner
Votre session est expirée, veuillez vous reconnecter
Accès interdit
Le service est momentanément indisponible
Impossible de se connecter au serveur
Vous n'êtes pas autorisé à consulter cette page
Ce contenu n'est pas disponible dans votre pays
Le serveur ne répond pas
Trop de requêtes, veuillez réessayer dans quelques minutes
Prouvez que vous n'êtes pas un robot
Votre texte ici
Contenu à venir prochainement
Texte provisoire à remplacer
Insérez votre description ici
À compléter plus tard
Ceci est un faux texte
Bonjour [Prénom], votre commande est prête.
Cordialement, [votre nom]
Rendez-vous le {{date}} à {{lieu}}.
""".strip().splitlines()

REAL = """
Use [optional] arguments and write List[str] for a list of strings.
Set x to {n} in the formula and solve it.
He said [laughs] that nobody knew the answer.
To turn on scripts, open the settings of your browser and look under privacy.
How do I enable JavaScript in my browser?
A 404 error means the server could not find the page you wanted.
Our team fixed the database connection last night and wrote a report.
Access denied. That is what the guard said to all who came to the gate in the morning.
Designers call dummy copy greeking and strip it before launch.
Cookies taste better when the butter is cold and the oven hot.
The page was torn out of the old book and never found again.
Please try the soup again later, it gets better with time.
The session of parliament expired without a vote on the budget.
We closed the road for maintenance and opened it before the feast.
The robot verified that the human had left the hall.
She could not connect the two facts until she read the letter.
The browser wars ended when one company gave its product away.
Requests for the loan were too many, so the bank slowed down.
The error in the sample was small, about two in a hundred.
Write your name at the top of the sheet before the exam begins.
The script was enabled by a grant from the ministry of culture.
The site was reached by a narrow path through the hills.
Search the home for old letters and contact a museum about them.
An error occurred in the second proof, so the third one starts anew.
In Python, f"{name}" puts the value of a variable into the text.
The interval [a, b] is closed, while (a, b) is open.
He wrote [sic] after the misspelt word.
The vector <x, y> points to the north.
Sort the list [3, 1, 2] and print it.
Use #hashtags# sparingly in formal writing.
Citations such as [Smith 2010] belong at the end of the sentence.
The template engine replaces names in double braces by their values.
Loading a truck takes longer when it rains.
Something went wrong between the brothers after the sale of the farm.
The link between sleep and memory is no longer in doubt.
A gateway to the old town stands at the end of the bridge.
The service was unavailable for two days, which cost the firm a client.
Ask an editor what placeholder text is and why printers used it.
Why does my browser say the connection timed out?
The magna carta was signed in a meadow by the river.
What does error 503 mean and how can I fix it on my server?
The test of the engine took three days and the test of the brakes two.
Students upgrade their browser labs with a modern computer each year.
Sed is a stream editor and awk is a small language for text.
Content creators add captions here and there for viewers who read.
The content of sugar in the fruit is added to the label soon after the harvest.
Your text arrived here at noon, and I answered at once.
The country is not available for the tournament this year.
The human must be able to refuse what the machine suggests.
Fill in the form at the office and keep a copy for yourself.
A denied permission to build can be appealed in court within a month.
Reload speed matters when the page holds many images, says the report.
The address on the parcel was missing, so it went back to the sender.
Maintenance of the lift is due in March and takes the whole morning.
In the second act the server drops the tray, and the guests laugh.
Internal errors of the clock come from heat, so it stands in a cool room.
Turn the pan, add the rice, and stir until the water is gone.
They moved the resource fund to a bank abroad and told nobody.
The article described how old pages are scanned and kept.
My session at the gym runs out in June, but I will sign on again.
يحل المهندس خطأ الاتصال بقاعدة البيانات بزيادة عدد المنافذ المفتوحة.
لتفعيل ملفات الارتباط افتح إعدادات المتصفح ثم اختر الخصوصية.
كيف أحل خطأ 404 في موقعي الجديد؟
الصفحة الأولى من الكتاب تتحدث عن تاريخ المدينة القديمة.
تعذر على الفريق الوصول إلى القمة بسبب الثلج فعاد في المساء.
انتهت صلاحية الحليب أمس فاشترينا غيره من السوق.
حدث خلل في المحرك بعد ألف كيلومتر فغير السائق الحزام.
يكتب الطالب النص هنا ثم يراجعه مع المعلم في نهاية الدرس.
تحت الصيانة كلمة يستخدمها السائقون حين تقف الشاحنة أياماً.
رفض الحارس دخول الزوار قبل صلاة العصر.
المصمم يسمي النص المؤقت حشواً ويحذفه قبل النشر.
سجل الدخول إلى المكتبة يحفظ أسماء الزوار منذ سنوات.
المحتوى العربي على الشبكة يزيد كل سنة بنسبة واضحة.
رقم المرجع مكتوب على ظهر الفاتورة فاحتفظ بها.
يدعم المتصفح الجديد اللغات التي تكتب من اليمين.
الخطأ الشائع هو البدء بالطلاء قبل تنظيف الجدار.
وش يعني خطأ 503 ومتى يظهر للمستخدم؟
الجلسة الأولى للمؤتمر تبدأ في التاسعة صباحاً.
تتكون القائمة من خمسة أطباق، والأخير منها حلو.
في الرياضيات نكتب المجموعة {س} ونقرأها مجموعة العنصر س.
قال الراوي [يضحك] إن أحداً لم يعرف الجواب.
التحميل الزائد على الشاحنة يضعف المكابح.
الموقع الأثري يستقبل الزوار في الشتاء فقط.
تحقق من أن الباب مغلق قبل أن تنام.
انتظر قليلاً حتى يبرد الخبز ثم قطعه.
Pour activer JavaScript, ouvrez les réglages puis la rubrique sécurité du navigateur.
Comment corriger une erreur 404 sur mon site ?
La page du manuscrit est conservée dans une bibliothèque de Lyon.
L'erreur du juge est survenue avant la fin du match et a tout changé.
Le service du soir commence à dix-neuf heures dans la grande salle.
Votre texte est clair, mais la fin mérite une autre phrase.
Le contenu du sac pesait plus lourd que prévu.
La session du parlement a repris après deux semaines de pause.
Une erreur 503 signifie que le serveur est trop occupé.
Les cookies au beurre sont meilleurs le lendemain.
Le site archéologique est fermé en hiver à cause de la neige.
L'accès au jardin est gratuit pour les enfants.
Il a noté [sic] après le mot mal écrit.
Le serveur apporte les plats et ne répond jamais aux critiques.
Pourquoi mon navigateur affiche-t-il une page blanche ?
La connexion entre les deux villages passe par un vieux pont.
Le robot du musée guide les visiteurs en trois langues.
Le lien entre le sommeil et la mémoire est bien établi.
La maintenance des ascenseurs est prévue en mars.
""".strip().splitlines()
