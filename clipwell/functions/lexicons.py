"""Default lexicons and thresholds. Results depend on them literally.

Every operator takes its lexicon as a parameter; these are only the defaults.
"""

from html.entities import html5

# Tokens that never count as keywords.
STOPWORDS = (
    "的", "了", "和", "是", "在", "就", "都", "很", "也", "与", "及", "以及",
    "我们", "你们", "他们", "这个", "那个", "真的", "可以", "但是", "因为", "所以", "然后",
    "视频", "账号", "内容", "the", "and", "for", "with", "this", "that",
)
TOKEN_PATTERN = r"([a-z0-9_]{2,}|[\x{4e00}-\x{9fff}]{2,})"

# Texts of page furniture that was captured as a comment.
COMMENT_NOISE = (
    "抖音电商直播间带货榜", "直播间带货榜当前分为", "商品类目榜", "抖音旗舰榜", "特色主题榜", "国家补贴榜",
    "带货力、互动力、吸引力", "为保证榜单时效性", "交易量等数据指标综合评估直播间主播的带货能力",
    "互动异常", "不同的用户看到的标签不尽相同",
)
COMMENT_NOISE_SHORT = ("直播间带货榜", "上榜直播间", "国家补贴榜", "排序规则", "平台将实时监控")

# Words that are field names, not comments; null words of ids.
COMMENT_KEYWORDS = ("comment", "reply", "content", "text")
NULL_WORDS = ("undefined", "null", "none", "nan", "false", "true")

# Response addresses that only the comment interface serves.
COMMENT_RESPONSES = (
    "/aweme/v1/web/comment/list", "/aweme/v1/web/comment/publish", "/aweme/v1/web/comment/list/reply",
)

# Candidate column names, in priority order.
VIDEO_ID_FIELDS = ("video_id", "aweme_id", "item_id", "id")
ACCOUNT_FIELDS = (
    "account_id", "source_name", "account_name", "author_id", "uid", "sec_uid", "homepage_url", "account",
)
TITLE_FIELDS = ("title", "video_title", "desc", "caption", "text")
VIEW_FIELDS = ("view_count", "play_count", "views", "view")
LIKE_FIELDS = ("like_count", "digg_count", "likes", "like")
COMMENT_FIELDS = ("comment_count", "comments_count", "reply_count", "comments")
SHARE_FIELDS = ("share_count", "shares", "share")
COMMENT_TEXT_FIELDS = ("comment_text", "text", "content", "comment")

# Metric keys of raw detail records and the containers they may sit in.
DETAIL_CONTAINERS = ("metrics", "statistics", "stats", "aweme_statistics", "stat")
DETAIL_KEYS = {
    "view_count": ("view_count", "play_count", "viewCount", "playCount"),
    "like_count": ("like_count", "digg_count", "likeCount", "diggCount"),
    "comment_count": ("comment_count", "commentCount"),
    "share_count": ("share_count", "shareCount"),
}

# Metric keys searched in raw pages.
PAGE_METRIC_KEYS = {
    "view_count": ("view_count", "play_count", "playCnt", "playcnt", "views"),
    "like_count": ("like_count", "digg_count", "favorite_count", "fav_count"),
    "comment_count": ("comment_count", "comments_count", "reply_count"),
    "share_count": ("share_count", "forward_count", "repost_count"),
}

# Title word groups.
TITLE_SUFFIX = " - 抖音"
GRADE_PATTERN = "[一二三四五六七八九1-9]年级|小升初|初中|小学"
TITLE_WORDS = {
    "has_method": ("方法", "技巧", "口诀", "公式", "干货", "避坑", "规划"),
    "has_material": ("资料", "领取", "打印", "练习", "作业", "清单"),
    "has_parent_child": ("孩子", "家长", "妈妈", "爸爸", "学生"),
    "has_interaction": ("评论", "你们", "知道", "留言", "收藏", "转发"),
    "has_subject": ("语文", "英语", "作文", "阅读", "单词", "数学"),
    "has_persona": ("老师", "同学", "学霸", "Chinese"),
}

# Comment topics, default first-round buckets, planned topics.
COMMENT_TOPICS = {
    "资料领取": ("资料", "打印", "领取", "在哪", "链接", "单词有吗"),
    "考试报考": ("ket", "pet", "报考", "真题", "考试", "听力", "阅读"),
    "家长咨询": ("我家", "孩子", "适合", "怎么办", "几岁", "几年级"),
    "难度质疑": ("太简单", "太难", "难度", "差距", "够不上"),
    "方法追问": ("怎么", "如何", "方法", "技巧", "训练"),
    "正向反馈": ("有用", "谢谢", "学到了", "收藏", "厉害"),
    "情绪/共鸣": ("哈哈", "笑", "同款", "一样", "真的"),
}
OTHER_TOPIC = "其他"
COMMENT_BUCKETS = {
    "资料/领取": ("资料", "领取", "发", "打印", "求", "链接"),
    "年级/作业": ("年级", "上册", "下册", "作业", "寒假"),
    "认同/夸赞": ("对", "是", "好", "厉害", "优秀", "谢谢"),
    "提问/求解": ("怎么", "为什么", "吗", "？", "?"),
    "争议/反驳": ("不是", "不对", "错", "但是", "可是"),
}
PLANNED_TOPICS = {
    "资料领取": ("资料", "打印", "领取", "链接", "私信"),
    "考试报考": ("ket", "pet", "报考", "真题", "考试", "听力", "阅读"),
    "家长咨询": ("孩子", "家长", "几年级", "适合", "怎么办"),
    "难度质疑": ("太简单", "太难", "难度", "差距", "避坑"),
    "方法追问": ("怎么", "如何", "方法", "技巧", "训练", "三步"),
}
NO_PLANNED_TOPIC = "未识别明确评论钩子"
DEMAND_TOPICS = ("资料领取", "考试报考", "家长咨询", "方法追问", "难度质疑")

# Sentiment rules in priority order, then neutral.
SENTIMENTS = {
    "质疑/负向": ("太简单", "差距", "不行", "错", "难", "够不上"),
    "正向": ("谢谢", "有用", "学到了", "厉害", "收藏"),
    "咨询": ("?", "？", "吗", "怎么", "如何", "在哪"),
}
NEUTRAL = "中性"
QUESTION = "咨询"

# Planned-text hooks and calls to action.
HOOK_WORDS = ("你知道", "为什么", "怎么", "如何", "别再", "一定要", "三步", "方法", "技巧", "避坑")
CTA_WORDS = ("评论", "留言", "私信", "领取", "资料", "收藏", "关注", "转发")
QUESTION_MARKS = ("?", "？")

# Script parts and knowledge words.
SCRIPT_PARTS = {
    "has_hook": ("你知道", "千万别", "很多家长", "一个方法", "三招", "别再", "为什么", "到底"),
    "has_pain_point": ("不会", "学不会", "粗心", "丢分", "焦虑", "没思路", "记不住", "跟不上", "错误"),
    "has_method": ("方法", "步骤", "先", "再", "最后", "公式", "技巧", "训练", "这样做"),
    "has_example": ("比如", "例如", "这道题", "举个例子", "来看", "我们看"),
    "has_cta": ("关注", "收藏", "点赞", "评论", "私信", "领取", "直播间", "主页"),
}
KNOWLEDGE_WORDS = ("知识点", "题型", "阅读", "作文", "语法", "单词", "数学", "语文", "英语", "考试")

# Pre-publish text parts and knowledge words.
PREPUBLISH_PARTS = {
    "pain": ("痛点", "不会", "容易错", "为什么", "难", "问题"),
    "method": ("方法", "三步", "技巧", "训练", "公式", "步骤"),
    "example": ("比如", "例如", "例子", "案例", "演示"),
}
PREPUBLISH_KNOWLEDGE = ("方法", "技巧", "训练", "公式", "步骤", "例子", "题", "阅读", "写作", "语文", "英语")

# HTML5 entity names (with or without the semicolon, as the standard has them) come from the standard library.
ENTITIES = html5
# Numeric references from 128 to 159 are read as Windows-1252.
WINDOWS_1252 = {c: bytes([c]).decode("cp1252", "ignore") for c in range(0x80, 0xA0)}

# Opening hooks of speech, punctuation outside the speech rate, subtitle keywords.
SPEECH_HOOKS = ("你知道", "千万别", "很多人", "很多家长", "为什么", "到底", "一个方法", "三招", "别再")
SPEECH_PUNCTUATION = r"[\s，。！？、,.!?；;：:\"'“”‘’（）()《》<>\[\]{}-]+"
SUBTITLE_KEYWORDS = "知识|方法|步骤|避坑|账号|视频|流量|转化|案例|技巧|重点|复盘|问题|解决|原因"
