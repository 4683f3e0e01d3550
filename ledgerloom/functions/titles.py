"""Titles that may precede a person or company name."""

# fixed values: title prefixes, in natural order
HONORIFICS = (
    "บริษัท", ".ริษัท", "56", "Co.,ltd.", "Dr", "Dr.", "K.", "Khun", "Miss", "MR.", "Mrs.", "Ms.", "Shop",
    "คณ", "คณะบุคคล", "คลีนิค", "คุณ", "คุณ.", "คุณว่าที่ร.ต.", "คุณหมอ", "คุณะ", "คุร", "งาน", "จ.สอ.",
    "จ.อ.", "จก.", "จสอ.", "จ่าสิบเอก", "ด.ต.", "ดร.", "ตัวอย่าง", "ทพญ.", "ธนาคาร", "น.พ.", "น.ส.", "นพ.",
    "นางสาว", "นาย", "นาวาอากาศโท", "นิติบุคคล", "บ.", "บจ.", "บจก.", "บมจ.", "บมจ.ธนาคาร", "บริษัท",
    "บริษํท", "ผกก.", "ผศ.", "ผศ.ดร.", "ผส.", "ผอ.", "ผอ.ดร.", "พ.ต.ท", "พ.ต.ท.", "พ.ต.อ", "พ.ต.อ.",
    "พ.ท.หญิง", "พ.อ", "พ.อ.", "พ.อ.อ.", "พญ.", "พล.ต.", "พล.ต.ต", "พล.ต.ต.", "พล.ตรี", "พลเอก", "พันตรี",
    "พันเอก", "พันเอก.ญ.", "พันโท", "มรว.", "มหาวิทยาลัย", "มูลนิธิสหพันธ์", "ร.ด.", "ร.ต.", "ร.ต.ท",
    "ร.ต.อ นพ.", "ร.ต.อ.", "รอ.ตร", "รัาน", "ร้าน", "ร้าน.", "ร้านที่นอน", "ร้านห้องเสื้อ", "วัด",
    "ว่าที่ร้อยตรี", "ศาตราจารย์ ดร.", "ส.ต.ท.", "ส.ท.", "ส.อ.", "ส.อ.หญิง", "สถาบัน", "สถาบันวิจัย",
    "สนง", "สนง.", "สหกรณ์", "สำนักงาน", "สำนักงานพัฒนา", "ห.จ.ก.", "ห.ส.ม.", "หจก", "หจก.", "หสน.",
    "หสน.จำกัด", "หสม", "หสม.", "หหสม.", "ห้องเสื้อ", "ห้าง", "ห้างกันสาด", "ห้างผ้า", "ห้างหุ้นส่วน",
    "อาจารย์", "โรงงาน", "โรงพยาบาล", "โรงเรียน", "โรงแรม",
)
